"""Pages, posts, attempts and edges that Spark derives from the given tables.

A derived page lists the orders of one block, the blocks of one shop or the lines of
one order, so no page grows with the tables; the number of pages does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagegraph.functions.urls import normalize_url

# Orders listed on one page, and orders of one shop.
BLOCK = 64
SHOP = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(column: str, block: int) -> Column:
    return F.expr(f"{column} div {block}")


def _filled(template: str, *numbers: Column | str) -> Column:
    """``format_string`` of integers for ``%d`` alone, without its parser; a null is "null" as there."""
    texts = template.split("%d")
    shown = [F.coalesce(F.col(n).cast("string") if isinstance(n, str) else n.cast("string"), F.lit("null")) for n in numbers]
    return F.concat(F.lit(texts[0]), *[part for n, text in zip(shown, texts[1:], strict=True) for part in (n, F.lit(text))])


def shop_url(shop: Column) -> Column:
    return _filled("http://h%d.shop.example", shop)


def _page(title: Column, body: Column) -> Column:
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title> "), title, F.lit("\n</title><script>var a='<a href=\"/no\">';</script></head><body>"),
        body, F.lit("</body></html>"),
    )


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per order: ways back, the parts with pictures, suppliers and mail
    links, and the clerk's address. Pending orders answer 404 without body, urgent
    ones redirect."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    line = F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))
    # The lines of one order, equal ones once.
    listed = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(line)).alias("lines"))
    # Dealt out first: orders may lie in one small file, and pages take long to read.
    orders = orders.repartition("o_orderkey").join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    shown = F.transform(
        "lines",
        lambda at: _filled(
            '<img src="/img/%d.png#x"><a href="http://S%d.supplier.example:80/p/%d/?o=1#top">part'
            '<a href="MAILTO: sales%d@supplier.example ?subject=x">',
            at["part"], at["supp"], at["part"], at["supp"],
        ),
    )
    body = F.concat(
        _filled(
            '<a href="/">home</a><a href="/list/%d/#here">list</a><a href=\'./%d\'>next<p>clerk%d@shop.example</p>',
            key("o_orderkey", BLOCK), F.col("o_orderkey") + 1, "o_custkey",
        ),
        F.coalesce(F.array_join(shown, ""), F.lit("")),
    )
    url = F.concat(shop_url(key("o_orderkey", SHOP)), _filled("/o/%d", "o_orderkey"))
    pending = F.col("o_orderstatus") == "P"
    return orders.select(
        url.alias("url"),
        F.when(pending, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(url, F.lit("/final"))).alias("final_url"),
        F.when(~pending, _page(_filled("Order %d &amp; parts", "o_orderkey"), body)).alias("html"),
    )


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per block of orders: home, its orders, the next list, and the first
    order of the next block."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey").distinct()
    blocks = orders.groupBy(key("o_orderkey", BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list("o_orderkey")).alias("orders")
    )
    links = F.transform("orders", lambda k: _filled('<a href="../o/%d">', k))
    body = F.concat(
        F.lit('<a href="/">'),
        F.array_join(links, ""),
        _filled(
            '<a href="/list/%d"><a href="/o/%d"><a href="javascript:void(0)">',
            F.col("block") + 1, (F.col("block") + 1) * BLOCK,
        ),
    )
    url = F.concat(shop_url(key("block", SHOP // BLOCK)), _filled("/list/%d/", "block"))
    return blocks.select(
        url.alias("url"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("final_url"),
        _page(_filled("List %d", "block"), body).alias("html"),
    )


def home_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per shop with its lists and one offsite link."""
    blocks = table(spark, sf_dir, "orders").select(key("o_orderkey", BLOCK).alias("block")).distinct()
    shops = blocks.groupBy(key("block", SHOP // BLOCK).alias("shop")).agg(
        F.sort_array(F.collect_list("block")).alias("blocks")
    )
    links = F.transform("blocks", lambda b: _filled('<a href="list/%d">', b))
    body = F.concat(F.lit('<a href="https://About.example">'), F.array_join(links, ""))
    return shops.select(
        _filled("HTTP://H%d.shop.example:80", "shop").alias("url"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("final_url"),
        _page(_filled("Shop %d", "shop"), body).alias("html"),
    )


def shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = order_pages(spark, sf_dir).unionByName(list_pages(spark, sf_dir))
    return pages.unionByName(home_pages(spark, sf_dir))


def shop_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shops' pages as a log of attempts: every other page timed out or met a
    server error first."""
    pages = shop_pages(spark, sf_dir)
    trouble = F.crc32("url") % 4
    answers = pages.select(
        "url",
        F.when(trouble < 2, 2).otherwise(1).alias("attempt"),
        "status",
        F.coalesce("final_url", normalize_url("url")).alias("final_url"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.col("html").alias("body"),
        F.lit(None).cast("string").alias("error"),
    )
    failures = pages.filter(trouble < 2).select(
        "url",
        F.lit(1).alias("attempt"),
        F.when(trouble == 0, 503).alias("status"),
        F.when(trouble == 0, F.col("url")).alias("final_url"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("body"),
        F.when(trouble == 1, "ReadTimeout").alias("error"),
    )
    return answers.unionByName(failures)


def shop_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = table(spark, sf_dir, "orders").select(key("o_orderkey", SHOP).alias("shop")).distinct()
    return shops.select(shop_url(F.col("shop")).alias("url"))


def post_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A social post per customer, with one of four shapes of handle. Posts of
    customers of nation 0 could not be fetched."""
    customers = table(spark, sf_dir, "customer")
    handle = F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey"))
    shape = F.col("c_custkey") % 4
    description = (
        F.when(shape == 0, F.concat(F.lit("9 likes - "), handle, F.lit(" on May 1")))
        .when(shape == 1, F.concat(handle, F.lit(" on May 1")))
        .when(shape == 2, F.lit("Photo by someone"))
    )
    og_title = F.when(shape == 2, F.concat(F.col("c_name"), F.lit(" (@"), handle, F.lit(") post"))).otherwise(
        F.when(shape == 3, handle).otherwise(F.col("c_name"))
    )
    image = F.when(F.col("c_acctbal") >= 0, F.format_string("https://img.example/%d.jpg", "c_custkey")).otherwise(" ")

    def tag(prop: str, content: Column) -> Column:
        return F.concat(F.lit(f'<meta property="{prop}" content=" '), content, F.lit(' ">'))

    html = F.concat(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("<title> </title>")).otherwise(
            F.concat(F.lit("<title>"), F.col("c_name"), F.lit("</title>"))
        ),
        F.coalesce(tag("og:description", description), F.lit("")),
        tag("og:title", og_title),
        tag("og:image", image),
    )
    lost = F.col("c_nationkey") == 0
    return customers.select(
        F.format_string("https://posts.example/p/%d/", "c_custkey").alias("url"),
        F.when(lost, F.lit(0)).otherwise(F.lit(200)).alias("status"),
        F.when(~lost, html).alias("html"),
    )


def post_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Description and title of the same four shapes, without any HTML."""
    handle = F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_custkey"))
    shape = F.col("c_custkey") % 4
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(shape == 0, F.concat(F.lit("9 likes - "), handle, F.lit(" on May 1")))
        .when(shape == 1, F.concat(handle, F.lit(" on May 1")))
        .alias("description"),
        F.when(shape == 2, F.concat(F.lit("Name (@"), handle, F.lit(") post")))
        .when(shape == 3, handle)
        .otherwise(F.col("c_name"))
        .alias("og_title"),
    )


# Errors of attempts without answer, by event number.
ERRORS = (
    "Timeout", "ReadTimeout", "ConnectTimeout", "requests.exceptions.SSLError",
    "ConnectionError", "ProxyError", "ReadTimeout", "TooManyRedirects",
)


def event_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt per event, counted per user and day. Sign-ups are attempts without
    answer: timeouts and failed connections, and in one of eight an error that no
    retry can cure."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    url = F.concat(F.format_string("http://u%d.example/", "user_id"), F.col("ts").cast("date").cast("string"))
    kind = F.col("event_type")
    errors = F.array(*[F.lit(name) for name in ERRORS])
    with_url = events.withColumn("url", url)
    order = Window.partitionBy("url").orderBy("ts", "event_id")
    return with_url.select(
        "url",
        F.row_number().over(order).alias("attempt"),
        F.when(kind == "error", 503).when(kind == "purchase", 404).when(kind != "signup", 200).alias("status"),
        F.when(kind != "signup", F.concat(F.col("url"), F.lit("/e"), F.col("event_id"))).alias("final_url"),
        F.when(kind == "view", "Text/HTML ; charset=utf-8").when(kind == "click", "application/json").alias("content_type"),
        F.col("props").alias("body"),
        F.when(kind == "signup", F.element_at(errors, (F.col("event_id") % len(ERRORS) + 1).cast("int"))).alias("error"),
    )


def _edge(src: Column, pos: Column, dst: Column) -> list[Column]:
    return [src.alias("src"), pos.cast("bigint").alias("pos"), dst.alias("dst")]


def _node(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column))


def geo_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region to nation to customer, children in key order."""
    nations = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer")
    region_edges = nations.select(*_edge(_node("r", "n_regionkey"), F.col("n_nationkey"), _node("n", "n_nationkey")))
    nation_edges = customers.select(*_edge(_node("n", "c_nationkey"), F.col("c_custkey"), _node("c", "c_custkey")))
    return region_edges.unionByName(nation_edges)


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer to order to part, and back from each order to its customer."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    customer, order = _node("c", "o_custkey"), _node("o", "o_orderkey")
    ahead = orders.select(*_edge(customer, F.col("o_orderkey"), order))
    back = orders.select(*_edge(order, F.lit(0), customer))
    parts = lines.select(*_edge(_node("o", "l_orderkey"), F.col("l_partkey") + 1, _node("p", "l_partkey")))
    return ahead.unionByName(back).unionByName(parts)
