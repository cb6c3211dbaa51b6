"""Domain tables derived from the given test tables, whole tables each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioflow.config import FlowConfig
from folioflow.functions import scalars as sc
from folioflow.operators.ordered import number_rows
from folioflow.session import cut_lineage

NTZ = "timestamp_ntz"
CFG = FlowConfig()


def ts(text: str):
    return F.lit(text).cast(NTZ)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @staticmethod
    def spread(rows: DataFrame) -> DataFrame:
        """Compact rows that grow into pages: a file of few splits is dealt to all cores before that, once."""
        return cut_lineage(rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism))

    # --- users ---

    def profiles(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"),
            ((F.col("c_custkey") * 37) % 100).alias("comments_count"),
            F.col("c_nationkey").cast("bigint").alias("friends_count"),
            F.floor("c_acctbal").cast("bigint").alias("followers_count"),
            F.col("c_mktsegment").alias("description"),
            ts("2024-01-31 00:00:00").alias("last_updated"),
        )

    def scanned_keys(self) -> DataFrame:
        return (
            self.events.filter("event_type = 'signup' AND user_id % 2 = 0")
            .select(sc.scanned_key(F.col("user_id")).alias("key")).distinct()
        )

    # --- quotes ---

    def quotes(self) -> DataFrame:
        key = F.col("l_partkey").cast("string")
        symbol = (
            F.when(F.col("l_partkey") % 6 == 0, F.concat(F.lit("SH"), F.lpad(key, 6, "0")))
            .when(F.col("l_partkey") % 6 == 1, F.lpad(key, 5, "0"))
            .when(F.col("l_partkey") % 6 == 2, F.upper(F.substring("p_name", 1, 3)))
            .when(F.col("l_partkey") % 6 == 3, F.lit("BRK.A"))
            .when(F.col("l_partkey") % 6 == 4, F.concat(F.lit("SZ"), F.lpad(key, 6, "0")))
            .otherwise(F.lit("GOOGL"))
        )
        lines = self.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_shipdate")
        buyers = self.orders.select("o_orderkey", "o_custkey")
        parts = self.part.select("p_partkey", "p_name")
        return (
            lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("o_custkey").alias("user_id"), F.col("p_name").alias("stock_name"),
                symbol.alias("stock_symbol"), F.col("l_extendedprice").alias("current_price"),
                F.col("l_discount").alias("percent"), sc.market_class(symbol).alias("market"),
                F.col("l_shipdate").alias("updated_at"), "l_orderkey", "l_linenumber",
            )
        )

    # --- portfolios ---

    @staticmethod
    def symbol_of(column: str):
        """At least six digits, and never cut: symbols are keys."""
        key = F.col(column).cast("string")
        return F.concat(F.lit("ZH"), F.lpad(key, F.greatest(F.lit(6), F.length(key)), F.lit("0")))

    def portfolios(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("comb_id"), self.symbol_of("o_orderkey").alias("symbol"),
            F.col("o_custkey").alias("creator_id"), F.col("o_totalprice").alias("net_value"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def portfolio_base(self) -> DataFrame:
        return self.portfolios().filter("comb_id % 3 <> 0")

    def portfolio_updates(self) -> DataFrame:
        return self.portfolios().filter("comb_id % 2 = 0").select(
            "comb_id", "symbol",
            F.when(F.col("comb_id") % 4 != 0, F.col("creator_id")).alias("creator_id"),
            (F.col("net_value") * 2).alias("net_value"), "updated_at",
        )

    def nested_positions(self) -> DataFrame:
        """One small document per line: a segment of two stocks, one of one, and an empty one."""
        stock = lambda name, price: F.struct(
            F.col(name).cast("string").alias("name"), F.col(price).cast("bigint").cast("string").alias("price"),
            F.col("l_linenumber").cast("string").alias("weight"))
        null_stock = F.lit(None).cast("struct<name: string, price: string, weight: string>")
        seg = lambda name, stocks: F.struct(
            F.col(name).alias("category_name"), F.lit("10%").alias("proportion"), stocks.alias("stocks"))
        return self.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.array(
                seg("l_returnflag", F.array(stock("l_partkey", "l_quantity"), null_stock,
                                            stock("l_suppkey", "l_quantity"))),
                seg("l_linestatus", F.when(F.col("l_linenumber") % 3 == 0, F.array().cast(
                    "array<struct<name: string, price: string, weight: string>>"))
                    .when(F.col("l_linenumber") % 3 == 1, F.array(null_stock))),
            ).alias("detailed_position"),
        )

    def null_positions(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_orderkey") % 50).alias("comb"), F.col("l_returnflag").alias("seg"),
            F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linestatus")).alias("stock"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        )

    TRADE_ORDER = ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]

    def trades(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_orderkey") % 1000).alias("comb"), (F.col("l_partkey") % 20).alias("stk"),
            F.year("l_shipdate").alias("yr"), *self.TRADE_ORDER,
        )

    # --- posts ---

    def posts(self) -> DataFrame:
        return self.events.select("event_id", "user_id", "ts", "event_type")

    def paged_posts(self, size: int = 10) -> DataFrame:
        """Posts of each user newest first, ``size`` to a page."""
        posts = self.posts()
        ranked = number_rows(posts, ["user_id"], [F.desc("ts"), F.desc("event_id")], "rn")
        return ranked.withColumn("page", F.floor((F.col("rn") - 1) / size))

    def follow_pages(self) -> DataFrame:
        """A tenth as many sources as customers, twenty follows to a page."""
        rows = self.orders.select(
            F.floor(F.col("o_custkey") / 10).alias("src"), F.col("o_custkey").alias("dst"),
            "o_orderkey", (F.col("o_totalprice") > 250000).alias("high"),
        )
        ranked = number_rows(rows, ["src"], ["o_orderkey"], "rn")
        return ranked.withColumn("page", F.floor((F.col("rn") - 1) / 20)).drop("rn")

    def follow_edges(self) -> DataFrame:
        users = self.customer.agg(F.count(F.lit(1)).alias("n")).scalar()
        return self.orders.select(
            F.col("o_custkey").alias("src"),
            ((F.col("o_custkey") * 7 + F.col("o_orderkey") * 13) % users).alias("dst"),
        )

    # --- verdicts ---

    def statuses(self) -> DataFrame:
        labels = self.labels.select(F.col("doc_id").alias("status_id"), "quality", "toxic")
        docs = self.documents.select(
            F.col("doc_id").alias("status_id"), F.col("text").alias("description"), "lang", "source")
        status = F.when(F.col("quality").isNull(), 0).when(F.col("toxic") == 1, 2).otherwise(1)
        return docs.join(labels, "status_id", "left").withColumn("is_analyzed", status)
