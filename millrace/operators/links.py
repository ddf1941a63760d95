"""Unchanged values that went through a change of key.

When a row gets a new key and a long value is left out of the message, the
value lies under the old key: in an earlier change, in the table, or behind yet another
change of key. The places are found first, as numbers; values are fetched at the end.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import use_checkpoints
from .merge import held_columns, held_value, key_columns
from .registry import TableShape

_SPAN_BITS = 20


def link_events(events: DataFrame, shape: TableShape) -> DataFrame:
    """Events that refer to a value under another key."""
    left_out = F.lit(False)
    for i in held_columns(shape):
        left_out = left_out | F.get("unchanged", F.lit(i))
    return events.where(F.col("from_key").isNotNull() & left_out)


def resolve_links(net: DataFrame, events: DataFrame, base: DataFrame, shape: TableShape) -> DataFrame:
    """Replace links in ``net`` by the values they stand for.

    ``net`` and ``events`` are read several times and should be written tables or cheap to redo.
    """
    use_checkpoints(net.sparkSession)
    places = _final_places(_first_places(events, shape))
    keys = key_columns(shape)
    held = held_columns(shape)
    links = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"c_{i}.link").isNotNull(),
                    F.struct(F.lit(i).alias("col"), F.col(f"c_{i}.link").alias("link")),
                )
                for i in held
            ]
        )
    )
    need = net.where("last.live").select(*keys, F.inline(links)).join(places, ["col", "link"])
    names = [c.name for c in shape.columns]
    in_log = need.where("source is not null").join(
        events.where("live").select(F.col("ord").alias("source"), "doc"), "source"
    )
    in_table = need.where("source is null").join(
        base.select(F.struct(*names).alias("doc")),
        [F.col(f"from_key.{k}") == F.col(f"doc.{k}") for k in shape.key],
    )
    found = in_log.select(*keys, "col", "doc").unionByName(in_table.select(*keys, "col", "doc"))
    fetched = found.groupBy(*keys).agg(
        *[
            F.first(
                F.when(F.col("col") == i, F.struct(F.col(f"doc.{names[i]}").alias("v"))),
                ignorenulls=True,
            ).alias(f"f_{i}")
            for i in held
        ]
    )
    no_link = F.lit(None).cast("bigint").alias("link")
    return net.join(fetched, keys, "left").select(
        *keys, "last",
        *[
            F.when(
                F.col(f"c_{i}.link").isNotNull(), F.struct(F.col(f"f_{i}.v").alias("v"), no_link)
            )
            .otherwise(F.col(f"c_{i}"))
            .alias(f"c_{i}")
            for i in held
        ],
    )


def _first_places(events: DataFrame, shape: TableShape) -> DataFrame:
    """For every link the newest earlier say on that column under the old key.

    ``source`` is an event with the value, ``parent`` another link; when both
    are null the value lies in the table under ``from_key``.
    """
    keys, held = key_columns(shape), held_columns(shape)
    links = link_events(events, shape).select(
        "ord", "from_key", *[F.col(f"from_key.{k}").alias(n) for k, n in zip(shape.key, keys)],
        F.explode(F.array_compact(F.array(
            *[F.when(F.get("unchanged", F.lit(i)), F.lit(i)) for i in held]
        ))).alias("col"),
    )
    says = F.array_compact(
        F.array(
            *[
                F.when(
                    held_value(shape, i).isNotNull(),
                    F.struct(
                        F.lit(i).alias("col"),
                        F.struct(
                            F.when(held_value(shape, i)["link"].isNull(), F.col("ord")).alias("source"),
                            held_value(shape, i)["link"].alias("parent"),
                        ).alias("say"),
                    ),
                )
                for i in held
            ]
        )
    )
    touched = links.select(*keys).distinct()
    told = events.where("live").join(touched, keys, "left_semi").select(*keys, "ord", F.inline(says))
    # A link asks just before the tombstone that its own message left on the old key.
    asked = links.select(*keys, (F.col("ord") - 1).alias("ord"), "col", "from_key", F.col("ord").alias("link"))
    both = told.unionByName(asked, allowMissingColumns=True).withColumn(
        "span", F.shiftright("ord", _SPAN_BITS)
    )
    near = Window.partitionBy(*keys, "col", "span").orderBy("ord")
    near = near.rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*keys, "col").orderBy("span")
    far = far.rowsBetween(Window.unboundedPreceding, -1)
    asked = both.withColumn("near", F.last("say", ignorenulls=True).over(near)).where("link is not null")
    spans = both.groupBy(*keys, "col", "span").agg(
        F.max_by("say", F.when(F.col("say").isNotNull(), F.col("ord"))).alias("say")
    )
    spans = spans.withColumn("far", F.last("say", ignorenulls=True).over(far)).drop("say")
    found = asked.join(spans, [*keys, "col", "span"]).withColumn("say", F.coalesce("near", "far"))
    return found.select("col", "link", "from_key", "say.source", "say.parent")


def _final_places(places: DataFrame) -> DataFrame:
    """Follow links to links; every round doubles the distance covered."""
    places = places.checkpoint()
    while not places.where("parent is not null").isEmpty():
        onward = places.select(
            "col", F.col("link").alias("parent"), F.col("from_key").alias("_key"),
            F.col("source").alias("_source"), F.col("parent").alias("_parent"),
        )
        hop = F.col("parent").isNotNull()
        places = (
            places.join(onward, ["col", "parent"], "left")
            .select(
                "col", "link",
                F.when(hop, F.col("_key")).otherwise(F.col("from_key")).alias("from_key"),
                F.when(hop, F.col("_source")).otherwise(F.col("source")).alias("source"),
                F.col("_parent").alias("parent"),
            )
            .checkpoint()
        )
    return places.drop("parent")
