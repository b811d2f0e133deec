"""Address classes from a table of blocks of any length.

A block lies in one bucket: the longest of a few prefix lengths that isn't longer than its own. Each distinct address is looked up in
the bucket of every length that the table uses, and the blocks it meets there are compared as ranges. So an address meets the blocks
of its own neighbourhood alone, and no block becomes part of a plan. For the fixed classes ``functions.addresses`` is the row-local form.
"""

from __future__ import annotations

import ipaddress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift import constants as K
from urlsift.functions.addresses import ipv4_number, ipv6_hex
from urlsift.runtime import small

#: Hexadecimal digits of a bucket, by family; one digit is four bits.
BUCKETS = {4: (6, 4, 2, 0), 6: (16, 12, 8, 4, 0)}
MAPPED = "0" * 20 + "ffff"


def _parsed(blocks: pa.Array) -> pa.Array:
    """family, first and last address in digits, and the bucket's digits, of each block; NULL for text that is none."""
    out = []
    for text in blocks.to_pylist():
        try:
            net = ipaddress.ip_network((text or "").strip(), strict=False)
        except ValueError:
            out.append(None)
            continue
        width = net.max_prefixlen // 4
        digits = next(n for n in BUCKETS[net.version] if 4 * n <= net.prefixlen)
        first, last = (f"{int(a):0{width}x}" for a in (net.network_address, net.broadcast_address))
        out.append({"family": net.version, "first": first, "last": last, "bucket": first[:digits]})
    return pa.array(out, pa.struct([("family", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("bucket", pa.string())]))


def block_table(blocks: DataFrame) -> DataFrame:
    """(family, bucket, first, last, reason, rank, exempt) from (block, reason, rank, exempt). A block is an address or a network; text that is
    neither is passed over. Of the reasons that hold for an address the one of least rank counts; an exempt block takes addresses out of its reason."""
    parse = F.arrow_udf(_parsed, "struct<family: int, first: string, last: string, bucket: string>")
    rows = blocks.select(parse(F.col("block").cast("string")).alias("b"), "reason", F.col("rank").cast("int").alias("rank"), F.col("exempt").cast("boolean").alias("exempt"))
    return rows.filter("b is not null").select("b.family", "b.bucket", "b.first", "b.last", "reason", "rank", "exempt").distinct()


def fixed_blocks(spark: SparkSession) -> DataFrame:
    """The fixed classes as (block, reason, rank, exempt)."""
    rows = []
    for ladder, public in ((K.IPV4_BLOCKS, K.IPV4_PUBLIC), (K.IPV6_BLOCKS, K.IPV6_PUBLIC)):
        for rank, (reason, nets) in enumerate(ladder):
            rows += [(n, reason, rank, False) for n in nets]
            rows += [(n, reason, rank, True) for n in public if reason == "private_address"]
    return spark.createDataFrame(rows, "block string, reason string, rank int, exempt boolean")


def address_digits(address: Column) -> Column:
    """struct<family, digits, mapped>: 8 digits of an IPv4 address, also of one mapped into IPv6, or 32; NULL for other text."""
    four, six = ipv4_number(address), ipv6_hex(address)
    plain = F.struct(F.lit(4).alias("family"), F.lower(F.lpad(F.hex(four), 8, "0")).alias("digits"), F.lit(False).alias("mapped"))
    inner = F.struct(F.lit(4).alias("family"), F.right(six, F.lit(8)).alias("digits"), F.lit(True).alias("mapped"))
    wide = F.struct(F.lit(6).alias("family"), six.alias("digits"), F.lit(False).alias("mapped"))
    return F.when(four.isNotNull(), plain).when(F.startswith(six, F.lit(MAPPED)), inner).when(six.isNotNull(), wide)


def address_reasons(rows: DataFrame, blocks: DataFrame, address: str) -> DataFrame:
    """(address, reason) of each distinct address of the rows that a block of the table forbids, or that is mapped; others have no row."""
    asked = rows.select(F.col(f"`{address}`").alias("address")).filter("address is not null").distinct()
    asked = asked.select("address", address_digits(F.col("address")).alias("a")).filter("a is not null").select("address", "a.*")
    sizes = [F.when(F.col("family") == f, F.array(*[F.lit(n) for n in ns])) for f, ns in BUCKETS.items()]
    looked = asked.withColumn("bucket", F.explode(F.transform(F.coalesce(*sizes), lambda n: F.substring(F.col("digits"), F.lit(1), n))))
    met = looked.join(small(blocks), ["family", "bucket"]).filter("digits between first and last")
    held = met.groupBy("address", "reason").agg(F.min("rank").alias("rank"), F.bool_or("exempt").alias("out"))
    found = held.filter("not out").groupBy("address").agg(F.min_by("reason", F.struct("rank", "reason")).alias("reason"))
    mapped = asked.filter("mapped").select("address", F.lit("ipv4_mapped").alias("reason"))
    return found.union(mapped.join(found, "address", "left_anti"))


def with_reason(rows: DataFrame, blocks: DataFrame, address: str, name: str = "reason") -> DataFrame:
    """Add why the row's address is no permissible destination; NULL for a public address and for text that is none."""
    found = address_reasons(rows, blocks, address).toDF("_address", "_reason")
    return rows.join(small(found), F.col(f"`{address}`") == F.col("_address"), "left").withColumn(name, F.col("_reason")).drop("_address", "_reason")
