"""An index per part of a layer: which keys it may hold, by range and Bloom filter.

A part's keys are dealt out by a hash to blocks of 32,768 bits, and each key sets ``HASHES`` bits of its block. With
about ``BITS_PER_KEY`` bits a key, one absent key in some hundred is taken for present, which costs
a needless read of a part and never a wrong result. The index is a layer of its own, in the same parts, and is
published with them; looking up a batch reads ranges of all parts, and bits of those parts whose range holds a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.snapshots import Snapshots

BLOCK_BITS = 32768  # what one bitmap of Spark holds
BITS_PER_KEY = 12
HASHES = 6


def _schema(low: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("of_part", T.StringType()),
            T.StructField("block", T.LongType()),
            T.StructField("blocks", T.LongType()),
            T.StructField("keys", T.LongType()),
            T.StructField("low", low),
            T.StructField("high", low),
            T.StructField("bits", T.BinaryType()),
        ]
    )


def _block(key: Sequence[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*key), blocks)


def _spots(key: Sequence[str]) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(f"bit {i}"), *key), F.lit(BLOCK_BITS)) for i in range(HASHES)])


def _is_set(bits: Column, spot: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (spot % 8).cast("int")) == 1


def part_index(rows: DataFrame, part: Column, key: Sequence[str]) -> DataFrame:
    """Index rows of the parts in ``rows``: a row per part and block, each with the part's key range."""
    keys = rows.select(part.alias("of_part"), *key)
    blocks = F.ceil(F.count("*") * BITS_PER_KEY / BLOCK_BITS).cast("long")
    ranges = keys.groupBy("of_part").agg(
        blocks.alias("blocks"), F.count("*").alias("keys"), F.min(key[0]).alias("low"), F.max(key[0]).alias("high")
    )
    placed = keys.join(ranges.select("of_part", "blocks"), "of_part")
    bits = placed.select("of_part", _block(key, F.col("blocks")).alias("block"), F.explode(_spots(key)).alias("spot"))
    bits = bits.groupBy("of_part", "block").agg(F.bitmap_construct_agg("spot").alias("bits"))
    return bits.join(ranges, "of_part").select("of_part", "block", "blocks", "keys", "low", "high", "bits")


def write_index(store: Snapshots, layer: str, rows: DataFrame, part: Column, key: Sequence[str]) -> dict[str, str]:
    """Write the candidate index of some parts; the folders to publish with them."""
    return store.write_parts(f"{layer}_index", part_index(rows, part, key), F.col("of_part"))


def parts_of_keys(store: Snapshots, layer: str, schema: T.StructType, batch: DataFrame, key: Sequence[str]) -> list[str]:
    """Names of the parts that may hold a key of the batch; the others hold none.

    A part without an index is always named. The driver sees one range per part, as it sees the parts' folders.
    """
    index = f"{layer}_index"
    folders = {n.removeprefix(f"{index}/"): f for n, f in store.parts(index).items()}
    bare = [n for n in (n.removeprefix(f"{layer}/") for n in store.parts(layer)) if n not in folders]
    near = near_parts(store, folders, schema, batch.select(*key).distinct(), key)
    return bare + ([r["of_part"] for r in near.select("of_part").distinct().collect()] if near is not None else [])


def near_parts(
    store: Snapshots, folders: dict[str, str], schema: T.StructType, keys: DataFrame, key: Sequence[str]
) -> DataFrame | None:
    """Each row of ``keys`` with every part, ``of_part``, that may hold its key, by the index in these folders; None without any."""
    table = _schema(schema[key[0]].dataType)

    def read(chosen: Sequence[str]) -> DataFrame:
        if not chosen:
            return store.spark.createDataFrame([], table)
        return store.spark.read.schema(table).parquet(*[f"{store.root}/{folders[n]}" for n in chosen])

    ranges = read(list(folders)).select("of_part", "blocks", "low", "high").distinct().collect()
    if not ranges:
        return None
    kinds = "struct<of_part:string,blocks:bigint,low:{0},high:{0}>".format(schema[key[0]].dataType.simpleString())
    spans = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("of_part", "blocks", "low", "high")]).cast(kinds) for r in ranges])
    first = F.col(key[0])
    near = F.filter(spans, lambda s: (s["low"] <= first) & (first <= s["high"]))
    asked = keys.select("*", F.inline(near)).drop("low", "high")
    asked = asked.withColumns({"block": _block(key, F.col("blocks")), "spots": _spots(key)})
    within = [r["of_part"] for r in asked.select("of_part").distinct().collect()]
    bits = read(within).select("of_part", "block", "bits")
    found = asked.join(bits, ["of_part", "block"]).where(F.forall("spots", lambda s: _is_set(F.col("bits"), s)))
    return found.select(*keys.columns, "of_part")
