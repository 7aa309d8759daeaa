"""The ``listings`` table: one row per line item, shaped like a used-car listing.

The driver tables carry no car data, so this view renames and derives the
listing columns from ``lineitem ⨝ orders ⨝ customer ⨝ part`` plus 15
embedding elements.  NULLs (in text and number columns), an invalid month, a zero power and a ``-``
sentinel are injected by fixed rules so every cleaning path is exercised.
The same definition exists as SQL (``LISTINGS_SQL``) for the DuckDB oracle.

Scale notes: ``lineitem ⨝ orders`` is a large-large equi-join (sort-merge on
the order key, both sides shuffled once); ``part`` and ``customer`` joins are
left to the planner (adaptive execution turns them into broadcasts when their
measured size is under the threshold).  The write does not sort by side.  ``embeddings`` is joined on
``l_partkey`` modulo its own row count, so every vector takes part; that join
is left to the planner too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hash_pct
from ..session import shared_path

N_V = 15          # anonymous numeric features v_0 .. v_14
NULL_V = (3, 7)   # those with injected NULLs
TEST_SHARE = 20   # percent of orders that form the unlabeled ``test`` side

LISTING_KEY = "sale_key"

#: Size of a row group: a file of any size is read by many tasks.
ROW_GROUP_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def yyyymmdd(c: Column, month: Column | None = None) -> Column:
    """Integer ``YYYYMMDD`` of a date/timestamp column."""
    m = F.month(c) if month is None else month
    return (F.year(c) * 10000 + m * 100 + F.dayofmonth(c)).cast("int")


_MATERIALIZED: dict[tuple[str, str], str] = {}
MATERIALIZE_CONF = "pricecraft.listings.materialize"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings table.

    By default it is built once per application (one pass of the four-way
    join) and written as Parquet, partitioned by ``source``, into the shared
    checkpoint folder; every later query scans that table with column pruning
    and partition pruning instead of repeating the join for each fitted
    statistic.  The written table also cuts lineage, so a lost executor costs
    a re-read, not a re-join.  Set ``pricecraft.listings.materialize=false``
    to get the lazy join instead.
    """
    if spark.conf.get(MATERIALIZE_CONF, "true").lower() != "true":
        return build_listings(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _MATERIALIZED.get(key)
    if path is None:
        path = shared_path(spark, "tables", "listings")
        _write_by_source(build_listings(spark, sf_dir), path)
        _MATERIALIZED[key] = path
    df = spark.read.parquet(path)
    return df.select(*LISTING_COLUMNS)


def _write_by_source(df: DataFrame, path: str) -> None:
    """Parquet partitioned by ``source``.  A task keeps a file open for each of
    the two sides; by default Spark would sort the wide rows by side first."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, "4")
    try:
        df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("source").parquet(path)
    finally:
        conf.set(key, before)


LISTING_COLUMNS = (["sale_key", "reg_date", "creat_date", "brand", "model", "body_type", "fuel_type", "gearbox",
                    "power", "kilometer", "not_repaired", "region_code", "offer_type", "price"]
                   + [f"v_{i}" for i in range(N_V)] + ["source"])


def build_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the listings DataFrame from the driver tables (lazy)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    vectors = table(spark, sf_dir, "embeddings")
    n_vec = max(vectors.count(), 1)             # from the file footers
    emb = (vectors
           .select(F.col("vec_id"),
                   *[F.try_element_at("embedding", F.lit(i + 1)).cast("double").alias(f"v_{i}")
                     for i in range(N_V)]))

    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(cust, F.col("o_custkey") == cust.c_custkey)
           .join(part, F.col("l_partkey") == part.p_partkey)
           .join(emb, (F.col("l_partkey") % n_vec) == F.col("vec_id"), "left"))

    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    return j.select(
        F.concat_ws("-", ok, pk, F.col("l_suppkey"), F.col("l_linenumber"),
                    yyyymmdd(F.col("l_shipdate"))).alias("sale_key"),
        yyyymmdd(F.col("o_orderdate"),
                 F.when(pk % 29 == 0, F.lit(0)).otherwise(F.month("o_orderdate"))).alias("reg_date"),
        yyyymmdd(F.col("l_shipdate")).alias("creat_date"),
        F.col("p_brand").alias("brand"),
        F.when(pk % 11 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("model"),
        F.when(ok % 13 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("body_type"),
        F.col("c_mktsegment").alias("fuel_type"),
        F.when(ok % 17 == 0, F.lit(None)).otherwise(F.col("l_linestatus")).alias("gearbox"),
        F.when(pk % 19 == 0, F.lit(0)).otherwise(F.col("p_size") * 8).cast("int").alias("power"),
        (F.col("l_quantity") / 2.0).alias("kilometer"),
        F.when(F.col("l_returnflag") == "A", "0.0")
         .when(F.col("l_returnflag") == "R", "1.0")
         .when(F.col("l_returnflag") == "N", "-").alias("not_repaired"),
        F.col("c_nationkey").cast("int").alias("region_code"),
        F.lit(0).alias("offer_type"),
        F.col("l_extendedprice").alias("price"),
        *[F.when(pk % 37 != 0, F.col(f"v_{i}")).alias(f"v_{i}") if i in NULL_V else F.col(f"v_{i}") for i in range(N_V)],
        F.when(hash_pct(ok) < TEST_SHARE, "test").otherwise("train").alias("source"),
    )


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two input tables of the pipeline: labeled ``train`` and ``test`` without price."""
    df = listings(spark, sf_dir)
    train = df.where(F.col("source") == "train").drop("source")
    test = df.where(F.col("source") == "test").drop("source", "price")
    return train, test


# Same table as DuckDB SQL; every oracle query starts with this CTE.
LISTINGS_SQL = """
listings AS (
  SELECT
    concat_ws('-', l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
      CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS INTEGER)) AS sale_key,
    CAST(year(o.o_orderdate) * 10000
         + (CASE WHEN l.l_partkey % 29 = 0 THEN 0 ELSE month(o.o_orderdate) END) * 100
         + day(o.o_orderdate) AS INTEGER) AS reg_date,
    CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS INTEGER) AS creat_date,
    p.p_brand AS brand,
    CASE WHEN l.l_partkey % 11 = 0 THEN NULL ELSE p.p_type END AS model,
    CASE WHEN l.l_orderkey % 13 = 0 THEN NULL ELSE o.o_orderpriority END AS body_type,
    c.c_mktsegment AS fuel_type,
    CASE WHEN l.l_orderkey % 17 = 0 THEN NULL ELSE l.l_linestatus END AS gearbox,
    CAST(CASE WHEN l.l_partkey % 19 = 0 THEN 0 ELSE p.p_size * 8 END AS INTEGER) AS power,
    l.l_quantity / 2.0 AS kilometer,
    CASE l.l_returnflag WHEN 'A' THEN '0.0' WHEN 'R' THEN '1.0' WHEN 'N' THEN '-' END AS not_repaired,
    CAST(c.c_nationkey AS INTEGER) AS region_code,
    CAST(0 AS INTEGER) AS offer_type,
    l.l_extendedprice AS price,
    {vcols},
    CASE WHEN ('0x' || substr(md5(CAST(l.l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 20
         THEN 'test' ELSE 'train' END AS source
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN embeddings e ON e.vec_id = l.l_partkey % (SELECT greatest(count(*), 1) FROM embeddings)
),
train AS (SELECT * EXCLUDE (source) FROM listings WHERE source = 'train'),
test AS (SELECT * EXCLUDE (source, price) FROM listings WHERE source = 'test')
""".replace("{vcols}", ",\n    ".join(
    f"CASE WHEN l.l_partkey % 37 <> 0 THEN CAST(e.embedding[{i + 1}] AS DOUBLE) END AS v_{i}" if i in NULL_V else
    f"CAST(e.embedding[{i + 1}] AS DOUBLE) AS v_{i}" for i in range(N_V)))


def with_listings(sql_body: str) -> str:
    """Prefix an oracle query with the listings/train/test CTEs."""
    return "WITH " + LISTINGS_SQL.strip() + "\n" + sql_body.strip()
