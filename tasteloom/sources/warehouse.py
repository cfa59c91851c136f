"""Views of a star schema (orders, parts, events, embeddings) in the library's terms.

Each property builds one lazily planned DataFrame; nothing is cached or collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteloom.functions.scalars import event_rating
from tasteloom.operators import splitting
from tasteloom.session import configure, write_stage

EVENT_KINDS = {"view": "view", "purchase": "purchase", "click": "cart", "signup": "like", "error": "wishlist"}
CART_ACTIONS = {"click": "add", "signup": "set", "error": "remove", "purchase": "checkout"}


def _mapped(column: str, mapping: dict[str, str]):
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def interactions(self) -> DataFrame:
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("user_id"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        )
        return self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(
            orders, "l_orderkey"
        ).select(
            "user_id",
            F.col("l_partkey").alias("item_id"),
            (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("rating"),
            "ts",
        )

    @cached_property
    def items(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("item_id"),
            F.col("p_name").alias("title"),
            F.when(key % 23 != 0, F.col("p_type")).alias("category"),
            F.when(key % 19 != 0, F.col("p_brand")).alias("brand"),
            F.when(key % 17 != 0, F.col("p_retailprice")).alias("price"),
            F.when(key % 13 != 0, F.lit(1) + (key * 7 % 41) / F.lit(10.0)).alias("avg_rating"),
        )

    @cached_property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))

    # ------------------------------------------------------------- time split
    @cached_property
    def frozen(self) -> DataFrame:
        """The interactions as narrow files: joined once, then scanned by every step of
        the protocol with pruned columns and pushed-down time filters."""
        return write_stage(self.interactions, "interactions")

    @cached_property
    def cuts(self) -> tuple[float, float]:
        return splitting.split_cuts(self.frozen)

    @cached_property
    def labelled(self) -> DataFrame:
        return splitting.label_split(self.frozen, self.cuts)

    @property
    def train(self) -> DataFrame:
        return self.frozen.where(F.col("ts") < self.cuts[0])

    @property
    def val(self) -> DataFrame:
        return self.frozen.where((F.col("ts") >= self.cuts[0]) & (F.col("ts") < self.cuts[1]))

    @property
    def test(self) -> DataFrame:
        return self.frozen.where(F.col("ts") >= self.cuts[1])

    # ------------------------------------------------------------- behaviour
    @cached_property
    def raw_events(self) -> DataFrame:
        """Events with epoch ms and a total order within equal timestamps."""
        return self.table("events").select(
            "event_id",
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
            "event_type",
            "value",
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        )

    @cached_property
    def live_events(self) -> DataFrame:
        kind = _mapped("event_type", EVENT_KINDS)
        return self.raw_events.select(
            "event_id", "user_id", "item_id", event_rating(kind).alias("rating"), "ts", kind.alias("event_type")
        )

    @cached_property
    def cart_log(self) -> DataFrame:
        action = _mapped("event_type", CART_ACTIONS)
        return self.raw_events.select(
            "user_id",
            "item_id",
            action.alias("action"),
            F.when(action == "set", F.floor("value") % 4).cast("bigint").alias("qty"),
            "ts",
            F.col("event_id").alias("seq"),
        ).where(F.col("action").isNotNull())

    @cached_property
    def wishlist_log(self) -> DataFrame:
        action = _mapped("event_type", {"click": "add", "error": "remove"})
        return self.raw_events.select(
            "user_id", "item_id", action.alias("action"), "ts", F.col("event_id").alias("seq")
        ).where(F.col("action").isNotNull())

    @cached_property
    def login_log(self) -> DataFrame:
        result = _mapped("event_type", {"error": "failed", "signup": "success"})
        return self.raw_events.select(
            "user_id", result.alias("result"), "ts", F.col("event_id").alias("seq")
        ).where(F.col("result").isNotNull())

    @cached_property
    def sessions(self) -> DataFrame:
        return self.raw_events.where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("token"), "user_id", F.col("ts").alias("created_at")
        )

    @cached_property
    def order_rows(self) -> DataFrame:
        bought = self.raw_events.where(F.col("event_type") == "purchase")
        return bought.join(self.items.select("item_id", "price"), "item_id").select(
            F.col("event_id").alias("order_id"),
            "user_id",
            "item_id",
            (1 + F.col("event_id") % 3).alias("qty"),
            "price",
            F.col("ts").alias("purchased_at"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("user_id"))

    @cached_property
    def latency_log(self) -> DataFrame:
        return self.table("events").select(
            F.create_map(F.col("event_type"), F.col("value")).alias("latency_ms")
        )

    @cached_property
    def raw_price(self) -> DataFrame:
        key, price = F.col("p_partkey"), F.col("p_retailprice")
        text = price.cast("decimal(18,2)").cast("string")
        high = (price + 10).cast("decimal(18,2)").cast("string")
        return self.table("part").select(
            key.alias("item_id"),
            F.when(key % 5 == 1, F.concat(F.lit("$"), text))
            .when(key % 5 == 2, F.concat(F.lit("$"), text, F.lit(" - $"), high))
            .when(key % 5 == 3, text)
            .when(key % 5 == 4, F.lit("call"))
            .alias("price"),
        )

    @cached_property
    def raw_meta(self) -> DataFrame:
        """Part rows as metadata records, with both image layouts."""
        key = F.col("p_partkey")
        url = F.concat(F.lit("img/"), key.cast("string"))
        one = F.struct(
            F.concat(url, F.lit("-t")).alias("thumb"),
            F.when(key % 4 == 0, F.concat(url, F.lit("-l"))).otherwise(F.lit("")).alias("large"),
            F.when(key % 3 == 0, F.concat(url, F.lit("-h"))).alias("hi_res"),
        )
        lists = F.struct(
            F.array(F.concat(url, F.lit("-t"))).alias("thumb"),
            F.when(key % 3 == 0, F.array(F.lit(""), F.concat(url, F.lit("-l")))).alias("large"),
            F.array(F.concat(url, F.lit("-h"))).alias("hi_res"),
        )
        images = (
            F.when(key % 7 == 0, F.lit("[]"))
            .when(key % 2 == 0, F.to_json(F.array(one)))
            .otherwise(F.to_json(lists))
        )
        path = F.when(key % 11 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type", "p_brand"))
        return self.table("part").join(self.raw_price.withColumnRenamed("item_id", "p_partkey"), "p_partkey").select(
            key.cast("string").alias("parent_asin"),
            F.col("p_name").alias("title"),
            images.alias("images"),
            path.alias("categories"),
            F.col("p_type").alias("main_category"),
            F.col("p_brand").alias("store"),
            "price",
            (F.lit(1) + (key * 7 % 41) / F.lit(10.0)).alias("average_rating"),
        )
