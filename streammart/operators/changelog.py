"""Change-log operators: cleaning, selection, transitions, routing, dimension upkeep.

Covers F1-F6, R1-R3 and K5. Input rows follow ``schemas.CHANGELOG``: an envelope with the row after
the change in ``data`` and the replaced cells in ``old``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammart.functions import as_decimal, as_int, keep_keys, not_blank
from streammart.operators.state import latest_per_key

# The change types a clean log may hold, and the prefix of bulk-load markers.
CHANGE_TYPES = ["insert", "update", "delete", "bootstrap-insert"]
BOOTSTRAP = "bootstrap-"

# Routes that may become a constant of the plan.
ROUTE_LIMIT = 1_000


def clean_changelog(changes: DataFrame, database: str) -> DataFrame:
    """Rows of one database with a known type and at least one data cell."""
    return changes.filter(
        (F.col("database") == database)
        & F.col("type").isin(CHANGE_TYPES)
        & (F.size(F.map_keys("data")) > 0)
    )


def drop_bootstrap(changes: DataFrame) -> DataFrame:
    """Without bulk-load rows and rows that name no type."""
    return changes.filter(not_blank("type") & ~F.col("type").contains(BOOTSTRAP))


def cells(columns: Mapping[str, str] | list[str], source: str = "data") -> list[Column]:
    """Map entries as columns: ``{"new_name": "map key"}`` or a list of keys."""
    pairs = columns.items() if isinstance(columns, Mapping) else [(c, c) for c in columns]
    return [F.col(source)[key].alias(name) for name, key in pairs]


def changes_of(
    changes: DataFrame,
    table: str,
    types: str | list[str],
    columns: Mapping[str, str] | list[str],
    database: str | None = None,
    keep: tuple[str, ...] = ("ts", "et"),
) -> DataFrame:
    """Changes of one table as columns, with the envelope's time."""
    kinds = [types] if isinstance(types, str) else types
    rows = changes.filter((F.col("table") == table) & F.col("type").isin(kinds))
    if database:
        rows = rows.filter(F.col("database") == database)
    return rows.select(*cells(columns), *[c for c in keep if c in changes.columns])


def transition(
    changes: DataFrame, column: str, to: str, frm: str | None = None
) -> DataFrame:
    """Updates that set ``column`` to ``to``; from ``frm``, or from any other value when None."""
    before = F.col("old")[column]
    left = before.isNotNull() if frm is None else before == frm
    return changes.filter((F.col("type") == "update") & left & (F.col("data")[column] == to))


def cart_additions(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Pieces put into carts: all of a new line, or the growth of an existing one.

    Both cases look at ``cart_info`` only. A looser reading would also take updates of any other
    table that happens to have a growing ``sku_num``.
    """
    now, before = as_int(F.col("data")["sku_num"]), as_int(F.col("old")["sku_num"])
    rows = changes.filter(F.col("table") == "cart_info")
    if database:
        rows = rows.filter(F.col("database") == database)
    rows = rows.filter((F.col("type") == "insert") | ((F.col("type") == "update") & (now > before)))
    added = F.when(F.col("old").isNull(), now).otherwise(now - before)
    times = [c for c in ("ts", "et") if c in changes.columns]
    return rows.select(*cells(["id", "user_id", "sku_id"]), added.cast("bigint").alias("sku_num"), *times)


def decimal_product(a: Column, b: Column) -> Column:
    """Exact product of two amounts held as text."""
    return as_decimal(a) * as_decimal(b)


def keep_columns(
    changes: DataFrame, wanted: Column | str, data: str = "data"
) -> DataFrame:
    """Prune the data map to the comma-separated keys in ``wanted``."""
    return changes.withColumn(data, keep_keys(data, wanted))


def current_config(
    snapshot: DataFrame | None, changes: DataFrame | None, keys: list[str]
) -> DataFrame:
    """The routes in force: the snapshot, overlaid with every change in ``ts_ms`` order.

    An update also retires the key it replaced, so a route whose source table was renamed does not
    stay alive under its old name.
    """
    events = None
    if changes is not None:
        put = changes.filter("op <> 'd'").select("ts_ms", F.lit(1).alias("_alive"), "after.*")
        # At equal time the removal of an old key ranks below a put of the same key.
        gone = changes.filter("op in ('u', 'd') and before is not null").select(
            "ts_ms", F.lit(0).alias("_alive"), "before.*"
        )
        events = put.unionByName(gone)
    if snapshot is not None:
        base = snapshot.withColumns({"ts_ms": F.lit(-1).cast("bigint"), "_alive": F.lit(1)})
        events = base if events is None else base.unionByName(events)
    newest = latest_per_key(events, keys, ["ts_ms", "_alive"])
    return newest.filter("_alive = 1").drop("ts_ms", "_alive")


def bounded_routes(config: DataFrame, limit: int = ROUTE_LIMIT) -> list[Row] | None:
    """The routes, or None when there are more than ``limit``: no more than that is ever fetched."""
    rows = config.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def with_routes(changes: DataFrame, config: DataFrame, on: dict[str, str], limit: int = ROUTE_LIMIT) -> DataFrame:
    """Every change once for each route it matches, the route as the struct ``_route``.

    ``on`` maps columns of the change to those of the route that must equal them; NULL matches nothing. Up to ``limit``
    routes, read when this is called, become a constant map that each row is looked up in: the log is neither shuffled
    nor meets a broadcast, and the names of its tables reach the scan as a filter. A running query calls this in
    each micro-batch and so follows the configuration. More routes than that are joined.
    """
    routes = bounded_routes(config, limit)
    same = [F.col(left) == F.col(f"_route.{right}") for left, right in on.items()]
    if routes is None:
        packed = config.select(F.struct(*config.columns).alias("_route"))
        return changes.join(packed, reduce(Column.__and__, same))
    first, first_of = next(iter(on.items()))
    by_name: dict[str, list[dict]] = {}
    for route in routes:
        if None not in [route[c] for c in on.values()]:
            by_name.setdefault(route[first_of], []).append(route.asDict())
    if not by_name:
        return changes.withColumn("_route", F.lit(None).cast(config.schema)).filter(F.lit(False))
    table = F.from_json(F.lit(json.dumps(by_name)), T.MapType(T.StringType(), T.ArrayType(config.schema)))
    routed = changes.filter(F.col(first).isin(sorted(by_name)))
    routed = routed.withColumn("_route", F.explode(F.try_element_at(table, F.col(first))))
    return routed.filter(reduce(Column.__and__, same))


def route_dims(changes: DataFrame, config: DataFrame, *keep: str) -> DataFrame:
    """Changes of configured tables, pruned to ``sink_columns``, with their destination."""
    config = config.select("source_table", "sink_table", "sink_columns", "sink_row_key")
    row_key = F.col("_route.sink_row_key")
    return with_routes(changes, config, {"table": "source_table"}).select(
        "_route.sink_table",
        "_route.sink_row_key",
        "type",
        keep_keys("data", "_route.sink_columns").alias("data"),
        F.col("data")[row_key].alias("row_key"),
        *[c for c in dict.fromkeys(("ts", "et", *keep)) if c in changes.columns],
    )


def route_facts(changes: DataFrame, config: DataFrame, database: str | None = None) -> DataFrame:
    """Changes whose (table, type) is configured, pruned and with ``ts`` added to the data."""
    rows = changes.filter(F.col("database") == database) if database else changes
    config = config.select("source_table", "source_type", "sink_table", "sink_columns")
    pruned = F.map_filter(keep_keys("data", "_route.sink_columns"), lambda k, _: k != "ts")
    return with_routes(rows, config, {"table": "source_table", "type": "source_type"}).select(
        "_route.sink_table",
        F.map_concat(pruned, F.create_map(F.lit("ts"), F.col("ts").cast("string"))).alias("data"),
        *[c for c in ("ts", "et") if c in changes.columns],
    )


def net_changes(
    changes: DataFrame, columns: list[str], order: list[str], null_overwrites: bool = False
) -> DataFrame:
    """All changes of one row key as one: what survives its last delete, cell by cell.

    A put leaves the cells it does not mention alone, so each cell keeps its own latest value and is
    void when a later delete removed the row. Only the newest value of a cell leaves a task.
    """
    at = F.struct(*order)
    is_delete = F.col("type") == "delete"
    newest = [
        F.max(
            F.when(
                ~is_delete & (F.lit(null_overwrites) | F.col("data")[c].isNotNull()),
                F.struct(at.alias("at"), F.col("data")[c].alias("v")),
            )
        ).alias(f"_c{i}")
        for i, c in enumerate(columns)
    ]
    grouped = changes.groupBy("row_key").agg(
        F.max(F.when(is_delete, at)).alias("_gone"),
        F.max(F.when(~is_delete, at)).alias("_put"),
        *newest,
    )
    alive = F.col("_gone").isNull() | (F.col("_put") > F.col("_gone"))
    wiped = F.col("_gone").isNotNull()

    def survives(i: int) -> Column:
        return F.col(f"_c{i}").isNotNull() & (~wiped | (F.col(f"_c{i}.at") > F.col("_gone")))

    return grouped.select(
        "row_key",
        F.coalesce(alive, F.lit(False)).alias("_alive"),
        wiped.alias("_wiped"),
        *[F.when(survives(i), F.col(f"_c{i}.v")).alias(c) for i, c in enumerate(columns)],
        *[survives(i).alias(f"_set{i}") for i in range(len(columns))],
    )


def apply_dim_changes(
    dim: DataFrame | None,
    changes: DataFrame,
    columns: list[str],
    order: list[str],
    null_overwrites: bool = False,
) -> DataFrame:
    """A dimension after its changes: ``row_key`` plus string columns, one row per key.

    ``changes`` holds ``row_key``, ``type``, ``data`` and the ``order`` columns. NULL cells of a put
    leave the stored cell alone unless ``null_overwrites``.
    """
    net = net_changes(changes, columns, order, null_overwrites)
    if dim is None:
        return net.filter("_alive").select("row_key", *columns)
    old = dim.select("row_key", *[F.col(c).alias(f"_old_{c}") for c in columns])
    both = old.join(net, "row_key", "full_outer").filter("coalesce(_alive, true)")
    return both.select(
        "row_key",
        *[
            F.when(F.col(f"_set{i}"), F.col(c))
            .when(~F.coalesce("_wiped", F.lit(False)), F.col(f"_old_{c}"))
            .alias(c)
            for i, c in enumerate(columns)
        ],
    )
