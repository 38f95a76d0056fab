"""Topic names: ``<prefix>.<engine>.<variant>[.<table or destination>]``, parts joined by dots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_name(*parts: Column | str) -> Column:
    """The parts joined by dots; a null part is left out."""
    return F.concat_ws(".", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def topic_for_table(prefix: str, table: Column) -> Column:
    """``<prefix>.<table>``, without the database that change capture puts between them."""
    return topic_name(prefix, table)


def split_topic(topic: Column) -> Column:
    """The parts of a topic name; ``tail`` is null where the name has no fourth part and may itself hold dots."""
    parts = F.split(topic, r"\.", 4)
    return F.struct(
        F.get(parts, F.lit(0)).alias("root"),
        F.get(parts, F.lit(1)).alias("engine"),
        F.get(parts, F.lit(2)).alias("variant"),
        F.get(parts, F.lit(3)).alias("tail"),
    )
