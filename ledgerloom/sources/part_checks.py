"""Standing checks of a layer in parts, kept up by the loads that rewrite its parts.

The counts of all row rules are stored per part and added up. A repeated key needs its two rows
looked at together: when a part is written, its own repeated keys are stored, and those keys that another part holds
too, which the index of that part tells but for a few that are then read. Such a row names the folder of
the other part, so it goes out of date by itself when that part is rewritten, whose load finds the key anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.quality import long_form
from ledgerloom.sources.contracts import TableContract
from ledgerloom.sources.part_index import near_parts
from ledgerloom.sources.snapshots import Snapshots

_COUNTS = "in_part string, rule string, violations long"


def _shared_schema(contract: TableContract) -> T.StructType:
    names = [T.StructField(c, T.StringType()) for c in ("in_part", "other_folder")]
    return T.StructType([*[contract.schema[k] for k in contract.key], *names])


def write_checks(
    store: Snapshots, layer: str, contract: TableContract, rows: DataFrame, part: Column, written: dict[str, str], index: dict[str, str]
) -> dict[str, str]:
    """Write the checks of parts just written; the folders to publish with them.

    ``rows`` are the rows of those parts, ``written`` and ``index`` the folders of all parts and their
    index as they will be.
    """
    key = list(contract.key)
    rows = rows.withColumn("in_part", part)
    rules = contract.rules()
    counted = rows.groupBy("in_part").agg(*[F.count_if(r.fails).alias(r.name) for r in rules])
    named = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations")) for r in rules])
    counts = counted.select("in_part", F.inline(named))

    folders = {n.removeprefix(f"{layer}/"): f for n, f in written.items()}
    own_folder = F.create_map(*[F.lit(x) for item in folders.items() for x in item]) if folders else F.lit(None)
    repeated = rows.groupBy("in_part", *key).agg(F.count("*").alias("n")).where("n > 1")
    shared = [repeated.select(*key, "in_part", own_folder[F.col("in_part")].alias("other_folder"))]
    near = near_parts(
        store, {n.removeprefix(f"{layer}_index/"): f for n, f in index.items()}, contract.schema, rows.select(*key, "in_part"), key
    )
    if near is not None:
        doubtful = near.where("of_part <> in_part").distinct()
        others = [r["of_part"] for r in doubtful.select("of_part").distinct().collect()]
        for other in others:  # of parts that the index takes for holders, the keys are read
            held = store.spark.read.schema(contract.schema).parquet(f"{store.root}/{folders[other]}").select(*key)
            both = doubtful.where(F.col("of_part") == other).join(held, key, "left_semi")
            shared.append(both.select(*key, "in_part", F.lit(folders[other]).alias("other_folder")))
    pairs = reduce(DataFrame.unionByName, shared)
    return {
        **store.write_parts(f"{layer}_checks", counts, F.col("in_part")),
        **store.write_parts(f"{layer}_shared", pairs, F.col("in_part")),
    }


def standing_violations(store: Snapshots, layer: str, contract: TableContract) -> DataFrame | None:
    """What ``contract.table_violations`` counts, from the stored checks; None if a part has none."""
    checked = {n.removeprefix(f"{layer}_checks/") for n in store.parts(f"{layer}_checks")}
    parts = {n.removeprefix(f"{layer}/"): f for n, f in store.parts(layer).items()}
    if not set(parts) <= checked:
        return None
    schema = T.StructType.fromDDL(_COUNTS)
    counts = store.read(f"{layer}_checks", schema).groupBy("rule").agg(F.sum("violations").alias("violations"))
    names = store.spark.createDataFrame([(r.name,) for r in contract.rules()], "rule string")
    counts = names.join(counts, "rule", "left").select("rule", F.coalesce("violations", F.lit(0)).alias("violations"))
    valid = store.read(f"{layer}_shared", _shared_schema(contract)).where(F.col("other_folder").isin(list(parts.values())))
    repeated = valid.select(*contract.key).distinct().agg(F.count("*").alias("key_unique"))
    return counts.unionByName(long_form(repeated, "rule", "violations"))
