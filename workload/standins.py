"""Inputs of the jobs, derived from the given tables.

Each text is SQL both engines read, so the queries and the comparison SQL start from the same
rows. ``{part}`` and the like name a given table; ``@name@`` another text of this module.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2016-01-01"
EVENTS_AS_OF = "2024-01-31"
LIVE_DAY = "2024-01-15"
FIRST_SERIES = 10000000

TEXTS = {
    # Viewing log with short ids and all three log layouts' fields, as text.
    "event_plays": """
        SELECT CAST(user_id AS STRING) AS user_id,
               CASE WHEN event_id % 50 = 7 THEN 'x' || regexp_extract(props, '([0-9]+)', 1)
                    ELSE regexp_extract(props, '([0-9]+)', 1) END AS content_id,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'ahyuvzq53adjct'
                    ELSE 'ahqhse8x8yr8ex' END AS product_key,
               CASE WHEN event_type = 'signup' THEN '2' ELSE '1' END AS play_type,
               CASE WHEN event_type = 'error' THEN '' ELSE '1' END AS flag4,
               CAST(CAST(floor(value) AS BIGINT) AS STRING) AS watch_seconds,
               ts
        FROM {events}""",
    "rated_plays": """
        SELECT CAST(user_id AS BIGINT) AS user_id, CAST(content_id AS BIGINT) AS item_id, CAST(watch_seconds AS DOUBLE) AS rating, ts
        FROM (@event_plays@) p WHERE content_id NOT LIKE 'x%'""",
    # Contents 0 to 59 of that log are episodes, ten to a series.
    "event_members": """
        SELECT DISTINCT 1000 + CAST(floor(item / 10) AS BIGINT) AS catalog_id, item AS content_id
        FROM (SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item FROM {events}) e
        WHERE item < 60""",
    "event_films": """
        SELECT DISTINCT item AS content_id, 'Film ' || CAST(item % 30 AS STRING) AS content_name
        FROM (SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item FROM {events}) e""",
    # Log of parts: every line is a play.
    "part_plays": """
        SELECT CAST(l_orderkey AS STRING) AS user_id,
               CAST(l_partkey AS STRING) AS content_id,
               CASE WHEN l_returnflag = 'R' THEN 'ahqhse8x8yr8ex' ELSE 'ahyuvzq53adjct' END AS product_key,
               CASE WHEN l_linestatus = 'O' THEN '1' ELSE '2' END AS play_type,
               CASE WHEN l_linenumber = 1 THEN '' ELSE '1' END AS flag4,
               CAST(CAST(floor(l_quantity * 3) AS BIGINT) AS STRING) AS watch_seconds
        FROM {lineitem}""",
    "customer_plays": """
        SELECT CAST(o_custkey AS STRING) AS user_id,
               CAST(l_partkey AS STRING) AS content_id,
               CASE WHEN l_returnflag = 'R' THEN 'ahqhse8x8yr8ex' ELSE 'ahyuvzq53adjct' END AS product_key
        FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey""",
    "ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating
        FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey""",
    "event_ratings": """
        SELECT user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id,
               CAST(floor(value) AS DOUBLE) AS rating
        FROM {events}""",
    # Parts of three types are episodes of a series of up to eight neighbours.
    "part_members": """
        SELECT 10000000 + CAST(floor(p_partkey / 8) AS BIGINT) AS catalog_id, p_partkey AS content_id
        FROM {part} WHERE p_type IN ('ECONOMY', 'SMALL', 'LARGE')""",
    "part_films": """
        SELECT p_partkey AS content_id, p_name AS content_name, CAST(p_size AS STRING) AS genre
        FROM {part}""",
    # Level rows of parts and series. A third of the parts share one level.
    "relation": """
        SELECT p_partkey AS content_id, p_name AS content_name, '0' AS series_type,
               CASE WHEN p_partkey % 3 = 0 THEN '107' ELSE CAST(100 + p_partkey % 5 AS STRING) END AS level1_id,
               CASE WHEN p_partkey % 5 = 1 THEN '' ELSE 'Level ' || CAST(p_partkey % 5 AS STRING) END AS level1_name,
               CASE WHEN p_size % 3 = 0 THEN '0' ELSE CAST(200 + p_size % 3 AS STRING) END AS level2_id,
               'Second ' || CAST(p_size % 3 AS STRING) AS level2_name,
               CASE WHEN p_size % 4 = 0 THEN CAST(300 + p_size % 7 AS STRING) ELSE '0' END AS level3_id,
               'Third ' || CAST(p_size % 7 AS STRING) AS level3_name,
               '0' AS level4_id, '' AS level4_name,
               CASE WHEN p_size % 10 = 0 THEN '501' ELSE '0' END AS level5_id,
               CAST(200 + p_size % 3 AS STRING) AS level6_id,
               '201' || CAST(p_partkey % 6 AS STRING) || '-' || lpad(CAST(1 + p_partkey % 12 AS STRING), 2, '0')
                   || '-' || lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0') AS resource_time
        FROM {part}
        UNION ALL
        SELECT catalog_id, 'Series ' || CAST(catalog_id AS STRING), '1',
               CASE WHEN catalog_id % 3 = 0 THEN '107' ELSE CAST(100 + catalog_id % 5 AS STRING) END,
               'Level ' || CAST(catalog_id % 5 AS STRING),
               CAST(200 + catalog_id % 2 AS STRING), 'Second ' || CAST(catalog_id % 2 AS STRING),
               '0', '', '0', '', '0', '0',
               '201' || CAST(catalog_id % 6 AS STRING) || '-' || lpad(CAST(1 + catalog_id % 12 AS STRING), 2, '0') || '-15'
        FROM (SELECT DISTINCT catalog_id FROM (@part_members@) m) s""",
    # Attribute rows with blank, "null" and unknown values.
    "content": """
        SELECT p_partkey AS content_id, p_name AS title,
               CASE WHEN p_partkey % 29 = 0 THEN 'null' ELSE p_type END AS genre,
               CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN '无'
                    WHEN p_partkey % 17 = 0 THEN NULL
                    ELSE '201' || CAST(3 + CAST(floor(p_partkey / 3) AS BIGINT) % 3 AS STRING) || '-'
                         || lpad(CAST(1 + p_partkey % 12 AS STRING), 2, '0') || '-'
                         || lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0') || ' 00:00:00' END AS create_time,
               CASE WHEN p_size % 10 = 0 THEN '' WHEN p_size % 7 = 0 THEN 'NULL'
                    ELSE 'C' || CAST(p_size % 2 AS STRING) END AS country,
               '0' AS series_type,
               CASE WHEN p_partkey % 3 = 0 THEN '10046284' WHEN p_partkey % 7 = 0 THEN '10001059'
                    ELSE '102' END AS level1_id,
               CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(200 + p_size % 3 AS STRING) END AS level2_id,
               CAST(p_size % 2 AS STRING) AS level3_id, '0' AS level4_id
        FROM {part}
        UNION ALL
        SELECT catalog_id, 'Series ' || CAST(catalog_id % 40 AS STRING), 'G' || CAST(catalog_id % 3 AS STRING),
               '201' || CAST(3 + CAST(floor(catalog_id / 3) AS BIGINT) % 3 AS STRING) || '-0' || CAST(1 + catalog_id % 9 AS STRING) || '-15',
               'C1', '1',
               CASE WHEN catalog_id % 3 = 0 THEN '10046284' ELSE '102' END,
               CASE WHEN catalog_id % 2 = 0 THEN NULL ELSE '201' END, '0', '0'
        FROM (SELECT DISTINCT catalog_id FROM (@part_members@) m) s""",
    "ott_elements": """
        SELECT p_partkey AS movie_id, p_name AS movie_name, 500 + p_size % 10 AS catalog_id,
               CASE WHEN p_size % 9 = 0 THEN '21' WHEN p_size % 11 = 0 THEN 'x'
                    ELSE CAST(p_size % 4 AS STRING) END AS type_id,
               CASE WHEN p_partkey % 31 = 0 THEN 'NULL' WHEN p_partkey % 37 = 0 THEN ''
                    ELSE p_type || ',' || p_brand END AS drama_type_id,
               2000 + p_size % 16 AS year
        FROM {part}""",
    "cinema_members": """
        SELECT 10001000 + p_size AS catalog_id, p_partkey AS content_id, p_partkey AS position FROM {part}
        UNION ALL
        SELECT 10002000 + CAST(floor(p_partkey / 40) AS BIGINT), p_partkey, p_partkey + 5
        FROM {part} WHERE p_type = 'PROMO'""",
    "web_catalog": """
        SELECT CAST(p_partkey % 3 AS STRING) AS level1_id,
               CASE WHEN p_size % 10 = 9 THEN 'x' ELSE CAST(p_size % 10 AS STRING) END AS level2_id,
               CAST(p_partkey AS STRING) AS movie_id
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey % 3 AS STRING), '77', CAST(p_partkey AS STRING)
        FROM {part} WHERE p_size < 8""",
    "web_elements": """
        SELECT CAST(p_partkey AS STRING) AS movie_id,
               CASE WHEN p_size % 8 = 0 THEN 'none' ELSE CAST(p_size AS STRING) END AS resource_code
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), '9' FROM {part} WHERE p_type = 'LARGE'""",
    "districts": "SELECT c_custkey AS user_id, c_nationkey AS district FROM {customer}",
    # Regions hold nations, nations hold customers; regions 0 to 2 lie below root 9.
    "tree_edges": """
        SELECT 10 + CAST(n_regionkey AS BIGINT) AS catalog_id, 1000 + CAST(n_nationkey AS BIGINT) AS content_id
        FROM {nation}
        UNION ALL
        SELECT 1000 + CAST(c_nationkey AS BIGINT), 100000 + c_custkey FROM {customer}""",
    "tree_parents": """
        SELECT 10 + CAST(r_regionkey AS BIGINT) AS catalog_id,
               CASE WHEN r_regionkey < 3 THEN 9 ELSE 8 END AS parent_id
        FROM {region}""",
    # A tree of about eight levels; some nodes stand below a second parent, some edges lead back up.
    "deep_edges": """
        SELECT CAST(floor(p_partkey / 3) AS BIGINT) AS catalog_id, p_partkey AS content_id FROM {part}
        UNION ALL
        SELECT p_partkey + 1, p_partkey FROM {part} WHERE p_partkey % 50 = 7
        UNION ALL
        SELECT p_partkey, CAST(floor(p_partkey / 27) AS BIGINT) FROM {part} WHERE p_partkey % 400 = 81
        UNION ALL
        SELECT p_partkey, p_partkey FROM {part} WHERE p_partkey % 90 = 5""",
    # Programme schedule, audience and filler library.
    "schedule_rows": """
        SELECT 'ch' || CAST(user_id AS STRING) AS channel_id, user_id AS service_id, ts AS start_time,
               1 + CAST(floor(value) AS BIGINT) AS minutes,
               CASE event_type WHEN 'view' THEN '电视剧' WHEN 'click' THEN '电影' WHEN 'purchase' THEN '体育'
                    WHEN 'signup' THEN '科教' ELSE '其他' END AS program_type,
               CASE WHEN event_id % 10 = 3 THEN '广告' ELSE 'w' END AS wiki_title
        FROM {events}""",
    "audience": """
        SELECT user_id AS channel, value AS tv_rating, CAST(ts AS DATE) AS date_time,
               lpad(CAST(hour(ts) AS STRING), 2, '0') || lpad(CAST(minute(ts) AS STRING), 2, '0') AS minute_time
        FROM {events}""",
    "hourly_audience": """
        SELECT user_id AS channel, value AS tv_rating, CAST(ts AS DATE) AS date_time,
               lpad(CAST(hour(ts) AS STRING), 2, '0') || '00' AS minute_time
        FROM {events}""",
    "channels": """
        SELECT DISTINCT user_id AS service_id, 'ch' || CAST(user_id AS STRING) AS channel_id,
               'Channel ' || CAST(user_id AS STRING) AS channel_name,
               'pic' || CAST(user_id % 7 AS STRING) AS channel_image
        FROM {events}""",
    "film_library": """
        SELECT p_partkey AS media_id, p_name AS name, p_size AS ind,
               CASE WHEN p_size % 4 <> 0 THEN 'pic' || CAST(p_partkey % 9 AS STRING) END AS image,
               CASE p_type WHEN 'ECONOMY' THEN 'tv' WHEN 'SMALL' THEN 'movie' WHEN 'LARGE' THEN 'cartoon'
                    WHEN 'PROMO' THEN 'variety' WHEN 'STANDARD' THEN 'variety' ELSE 'other' END AS mtype,
               CASE p_size % 7 WHEN 0 THEN '运动' WHEN 1 THEN '爱情' WHEN 2 THEN '纪实' WHEN 3 THEN '纪实 真人秀'
                    WHEN 4 THEN '科教' ELSE '' END AS tags,
               CASE p_size % 5 WHEN 0 THEN '运动' WHEN 1 THEN '证券' WHEN 2 THEN '房地产' ELSE '' END AS plots,
               CASE WHEN p_size % 6 = 0 THEN '股市' ELSE '' END AS adword
        FROM {part}""",
    "programme_catalogue": """
        SELECT p_partkey AS media_id, p_name AS name, p_size % 3 AS type, 'c' || CAST(p_size % 9 AS STRING) AS category_code,
               CASE WHEN p_size % 9 <> 2 THEN p_brand END AS category_name,
               CASE p_type WHEN 'ECONOMY' THEN '电视剧' WHEN 'SMALL' THEN '电影' WHEN 'LARGE' THEN '少儿'
                    WHEN 'PROMO' THEN '纪实' WHEN 'STANDARD' THEN '体育'
                    ELSE CASE WHEN p_size % 2 = 0 THEN '财经' ELSE '娱乐' END END AS ptype,
               CASE WHEN p_size % 4 = 0 THEN 2014 ELSE 2015 END AS year,
               CASE WHEN p_size % 5 = 0 THEN '自然' ELSE '' END AS tags,
               CASE WHEN p_size % 6 = 0 THEN '' ELSE 'img' END AS big_image,
               CASE WHEN p_size % 8 = 0 THEN '' ELSE 'item' END AS category_item_code
        FROM {part}""",
}


def expand(name: str) -> str:
    """The text of a stand-in with the texts it builds on."""
    return re.sub(r"@(\w+)@", lambda m: expand(m.group(1)), TEXTS[name])


def duck(name: str) -> str:
    """The text with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", expand(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = expand(name)
    tables = {t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **tables)


def series_catalog(members: DataFrame) -> DataFrame:
    """Catalogue rows of series with their ``;`` list; a series has a handful of episodes."""
    ids = F.transform(F.array_sort(F.collect_list("content_id")), lambda x: x.cast("string"))
    return members.groupBy("catalog_id").agg(F.concat_ws(";", ids).alias("sort_index")).select(
        "catalog_id",
        F.lit(10046284).cast("bigint").alias("parent_id"),
        F.concat(F.lit("Series "), F.col("catalog_id").cast("string")).alias("name"),
        F.lit(1).alias("type"),
        "sort_index",
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "schedule_rows")
    return rows.withColumn("end_time", F.expr("timestampadd(MINUTE, minutes, start_time)")).drop("minutes")
