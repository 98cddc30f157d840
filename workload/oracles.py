"""Comparison SQL of the registered queries, written over pairs and full windows on purpose."""

from __future__ import annotations

from collections.abc import Sequence

from viewloom.operators.airtime import PROGRAM_TYPES
from workload.standins import duck

ORACLES: dict[str, str] = {}

MISSING = "('', 'null', 'NULL', '无')"


def _with(*names: str, **texts: str) -> str:
    parts = [f"{n} AS ({duck(n)})" for n in names] + [f"{n} AS ({t})" for n, t in texts.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def _digits(*columns: str) -> str:
    return " AND ".join(f"regexp_full_match({c}, '[0-9]+')" for c in columns)


def _window(span: int, skip: int = 0) -> str:
    return (
        f"ts >= TIMESTAMP '2024-01-31' - INTERVAL {span} DAY AND ts < TIMESTAMP '2024-01-31' - INTERVAL {skip} DAY"
    )


def _item_json(movie: str, rank: str, name: str = "''", provider: str = "''") -> str:
    return (
        f"""'{{"assetId":"","assetname":"' || coalesce({name}, '') || '","assetpic":"","movieID":"' || {movie} """
        f"""|| '","providerId":"' || {provider} || '","rank":"' || {rank} || '"}}'"""
    )


def _top_json(movie: str, rank: str, name: str, parent_name: str, parent_id: str) -> str:
    return (
        f"""'{{"assetId":"","assetname":"' || coalesce({name}, '') || '","assetpic":"","movieID":"' || {movie} """
        f"""|| '","parentName":"' || coalesce({parent_name}, '') || '","parentid":"' || coalesce({parent_id}, '') """
        f"""|| '","providerId":"","rank":"' || {rank} || '"}}'"""
    )


# Sources, cleaning, lookups

ORACLES["scan_date_window"] = f"SELECT event_id, user_id, event_type FROM events WHERE {_window(10)}"

ORACLES["valid_ids"] = _with("event_plays") + f"""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(content_id AS BIGINT) AS content_id, flag4 FROM event_plays
WHERE {_digits('user_id', 'content_id')} AND length(user_id) < 3 AND length(content_id) < 3"""

_KNOWN = "CASE WHEN trim({0}) NOT IN " + MISSING + " THEN {0} END"

ORACLES["blank_as_null"] = _with("content") + f"""
SELECT content_id, {_KNOWN.format('genre')} AS genre, {_KNOWN.format('country')} AS country,
       CAST(replace(split_part({_KNOWN.format('create_time')}, ' ', 1), '-', '') AS INT) AS day_number
FROM content"""

ORACLES["text_rules"] = _with("ott_elements") + """
SELECT movie_id, split_part(drama_type_id, ',', 1) AS code,
       CASE WHEN type_id = '2' THEN 1 ELSE 0 END AS series_type,
       regexp_replace(drama_type_id, '[^0-9]', '', 'g') AS digits,
       movie_id || ',' || type_id AS line
FROM ott_elements"""

# One row per episode: its series, the series' length and name.
EPISODES = """
SELECT content_id, catalog_id AS series_id, n_episodes, 'Series ' || catalog_id AS series_name
FROM (SELECT content_id, catalog_id, count(*) OVER (PARTITION BY catalog_id) AS n_episodes FROM {members}) m
QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY catalog_id DESC) = 1"""
PART_EPISODES = EPISODES.format(members="part_members")
EVENT_EPISODES = EPISODES.format(members="event_members")

ORACLES["episode_lookup"] = _with("part_members", episodes=PART_EPISODES) + """
SELECT content_id, series_id, CAST(n_episodes AS INT) AS n_episodes, series_name FROM episodes"""

ORACLES["catalog_children"] = _with("part_members") + """
SELECT catalog_id, content_id,
       CAST(row_number() OVER (PARTITION BY catalog_id ORDER BY content_id) - 1 AS INT) AS position
FROM part_members"""

_LEVELS = "\nUNION ALL\n".join(
    f"""SELECT content_id, {i} AS level_no, level{i}_id AS level_id,
       CASE WHEN level{i}_name = '' THEN '1' ELSE level{i}_name END AS level_name
FROM relation WHERE level{i}_id <> '0'"""
    for i in range(1, 5)
)
ORACLES["level_unpivot"] = _with("relation") + _LEVELS

ORACLES["content_metadata"] = _with("relation", "part_films", "part_members") + """
SELECT r.content_id, series_type, level1_id, f.content_name AS title
FROM relation r JOIN part_films f ON r.content_id = f.content_id
UNION ALL
SELECT r.content_id, series_type, level1_id, 'Series ' || r.content_id
FROM relation r JOIN (SELECT DISTINCT catalog_id FROM part_members) m ON r.content_id = m.catalog_id"""

# Counts, progress, similarity


def _counts(where: str, plays: str = "event_plays") -> str:
    return f"""SELECT CAST(user_id AS BIGINT) AS user_id, CAST(content_id AS BIGINT) AS content_id, count(*) AS plays
FROM {plays} WHERE {_digits('user_id', 'content_id')} AND {where} GROUP BY 1, 2"""


_ROLLED = """SELECT user_id, coalesce(series_id, c.content_id) AS item_id, CAST(sum(plays) AS BIGINT) AS plays
FROM counts c LEFT JOIN episodes e ON c.content_id = e.content_id GROUP BY 1, 2"""

_FREE = "product_key = 'ahyuvzq53adjct'"
_CINEMA = "product_key = 'ahqhse8x8yr8ex'"

ORACLES["user_item_counts"] = _with(
    "event_plays", counts=_counts(f"play_type = '1' AND flag4 <> '' AND {_window(30)}")
) + "SELECT user_id, content_id AS item_id, plays FROM counts"

ORACLES["series_rollup_counts"] = _with(
    "event_plays", "event_members", episodes=EVENT_EPISODES, counts=_counts(f"{_FREE} AND {_window(30)}")
) + _ROLLED

ORACLES["customer_series_counts"] = _with(
    "customer_plays", "part_members", episodes=PART_EPISODES, counts=_counts("TRUE", "customer_plays")
) + _ROLLED

ORACLES["count_sample"] = ORACLES["series_rollup_counts"] + " ORDER BY 1, 2 LIMIT 100"

ORACLES["live_plays"] = _with("event_plays") + f"""
SELECT CAST(user_id AS BIGINT) AS user_id, CAST(content_id AS BIGINT) AS content_id FROM event_plays
WHERE play_type = '2' AND flag4 <> '' AND {_digits('user_id', 'content_id')} AND {_window(30)}"""

_PROGRESS = """SELECT CAST(user_id AS BIGINT) AS user_id, series_id, n_episodes AS total,
       count(DISTINCT e.content_id) AS watched, count(DISTINCT e.content_id) / CAST(n_episodes AS DOUBLE) AS ratio
FROM customer_plays p JOIN episodes e ON CAST(p.content_id AS BIGINT) = e.content_id GROUP BY 1, 2, 3"""
_WITH_PROGRESS = _with("customer_plays", "part_members", episodes=PART_EPISODES, progress=_PROGRESS)

ORACLES["series_completion"] = _WITH_PROGRESS + """
SELECT user_id, series_id, total, watched, round(ratio, 9) AS ratio FROM progress"""

_BIN = " ".join(f"WHEN ratio <= 0.{i} THEN 0.{i}" for i in range(1, 10))
ORACLES["completion_histogram"] = _WITH_PROGRESS + f"""
SELECT bin, n, CAST(sum(n) OVER () AS BIGINT) AS total, round(n / CAST(sum(n) OVER () AS DOUBLE), 9) AS share
FROM (SELECT CAST(CASE WHEN ratio < 0 THEN 1.0 {_BIN} ELSE 1.0 END AS DOUBLE) AS bin, count(*) AS n
      FROM progress GROUP BY 1) h"""


def _similarity(ratings: str) -> str:
    return _with(
        ratings,
        u=f"SELECT user_id, item_id, CAST(max(rating) AS DOUBLE) AS rating FROM {ratings} GROUP BY 1, 2",
        c="SELECT item_id, count(*) AS raters FROM u GROUP BY 1",
        m="""SELECT a.item_id AS item1, b.item_id AS item2, CAST(count(*) AS DOUBLE) AS n,
       sum(a.rating * b.rating) AS xy, sum(a.rating) AS x, sum(b.rating) AS y,
       sum(a.rating * a.rating) AS xx, sum(b.rating * b.rating) AS yy
FROM u a JOIN u b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2""",
        s="""SELECT *, sqrt(greatest(n * xx - x * x, 0.0)) * sqrt(greatest(n * yy - y * y, 0.0)) AS spread,
       sqrt(xx) * sqrt(yy) AS norms FROM m""",
        k="SELECT *, CASE WHEN spread = 0 THEN NULL ELSE (n * xy - x * y) / spread END AS corr FROM s",
    ) + """
SELECT item1, item2, round(corr, 6) AS corr, round(n / (n + 10.0) * corr, 6) AS reg_corr,
       round(CASE WHEN norms = 0 THEN NULL ELSE xy / norms END, 6) AS cos_sim,
       round(n / (c1.raters + c2.raters - n), 6) AS jaccard
FROM k JOIN c c1 ON item1 = c1.item_id JOIN c c2 ON item2 = c2.item_id"""


ORACLES["itemcf_similarity"] = _similarity("event_ratings")
ORACLES["itemcf_ratings_bench"] = _similarity("ratings")

# Most-viewed lists

_FILM_NAMES = """SELECT content_id, max(content_name) AS content_name FROM part_films
WHERE genre NOT LIKE '%11%' AND genre NOT LIKE '%20%' AND genre NOT LIKE '%41%' GROUP BY 1"""


def _box_top(series_type: int, key: str, kind: str = "part", films: str = _FILM_NAMES, episodes: str = PART_EPISODES, where: str = "TRUE") -> str:
    return _with(
        f"{kind}_plays",
        f"{kind}_films",
        f"{kind}_members",
        films=films,
        episodes=episodes,
        counts=f"SELECT CAST(content_id AS BIGINT) AS content_id, count(*) AS plays FROM {kind}_plays WHERE {_FREE} AND {where} GROUP BY 1",
        views="""SELECT coalesce(series_id, c.content_id) AS item_id, CASE WHEN series_id IS NULL THEN 0 ELSE 1 END AS series_type,
       coalesce(series_name, content_name) AS item_name,
       CAST(sum(plays) AS DOUBLE) / coalesce(n_episodes, 1) AS views
FROM counts c LEFT JOIN episodes e ON c.content_id = e.content_id LEFT JOIN films f ON c.content_id = f.content_id
WHERE series_id IS NOT NULL OR content_name IS NOT NULL GROUP BY 1, 2, 3, n_episodes""",
        ranked="""SELECT *, row_number() OVER (PARTITION BY series_type ORDER BY views DESC, item_id) AS rank,
       count(*) OVER (PARTITION BY series_type) AS n FROM views""",
        listed="""SELECT *, row_number() OVER (PARTITION BY series_type, item_name ORDER BY rank) AS nth
FROM ranked WHERE rank <= 20 AND n > 20""",
    ) + f"""
SELECT '{key}' AS list_key, CAST(rank AS INT) AS rank, item_id, item_name, round(views, 9) AS views,
       {_top_json('item_id', 'rank', 'item_name', "''", "'10046284'")} AS payload
FROM listed WHERE nth = 1 AND series_type = {series_type}"""


ORACLES["topn_films"] = _box_top(0, "Topcontentlist_5_10046284")
ORACLES["topn_series"] = _box_top(1, "Topcontentlist_5_10046284_1")

_LONG_VIEWS = """SELECT coalesce(series_id, c.content_id) AS item_id,
       CASE WHEN series_id IS NULL THEN 0 ELSE 1 END AS series_type, CAST(sum(plays) AS DOUBLE) AS views
FROM counts c LEFT JOIN episodes e ON c.content_id = e.content_id GROUP BY 1, 2"""
_LONG_COUNTS = """SELECT CAST(content_id AS BIGINT) AS content_id, count(*) AS plays FROM part_plays
WHERE CAST(watch_seconds AS BIGINT) > 60 GROUP BY 1"""

_LEVEL_VIEWS = "\nUNION ALL\n".join(
    f"""SELECT {i} AS level_no, level{i}_id AS level_id,
       CASE WHEN level{i}_name = '' THEN '1' ELSE level{i}_name END AS level_name, {kind} AS series_type,
       item_id, content_name, views
FROM views v JOIN relation r ON v.item_id = r.content_id WHERE level{i}_id <> '0'"""
    for i in range(1, 5)
    for kind in ("NULL", "CAST(v.series_type AS VARCHAR)")
)
_LEVEL_KEY = "'Topcontentlist_5_' || level_id || coalesce('_' || series_type, '')"
ORACLES["topn_by_level_and_type"] = _with(
    "part_plays",
    "relation",
    "part_members",
    episodes=PART_EPISODES,
    counts=_LONG_COUNTS,
    views=_LONG_VIEWS,
    placed=_LEVEL_VIEWS,
    ranked="""SELECT *, row_number() OVER (PARTITION BY level_no, level_id, level_name, series_type
       ORDER BY views DESC, item_id) AS rank FROM placed""",
    keyed=f"""SELECT *, {_LEVEL_KEY} AS list_key,
       dense_rank() OVER (PARTITION BY {_LEVEL_KEY} ORDER BY level_no DESC, level_name DESC) AS nth
FROM ranked WHERE rank <= 20""",
    listed="SELECT *, count(*) OVER (PARTITION BY list_key) AS n FROM keyed WHERE nth = 1",
) + f"""
SELECT list_key, CAST(rank AS INT) AS rank, item_id, series_type, views,
       {_top_json('item_id', 'rank', 'content_name', 'level_name', 'level_id')} AS payload
FROM listed WHERE n > 5"""

ORACLES["topn_level1_list"] = _with(
    "part_plays",
    "relation",
    "part_members",
    episodes=PART_EPISODES,
    counts=_LONG_COUNTS,
    views=_LONG_VIEWS,
    ranked="""SELECT level1_id, item_id, row_number() OVER (PARTITION BY level1_id
       ORDER BY views DESC, item_id, v.series_type) AS rank
FROM views v JOIN relation r ON v.item_id = r.content_id WHERE level1_id <> '0'""",
) + """
SELECT 'Topcontentlist_5_' || level1_id AS list_key, string_agg(item_id, '#' ORDER BY rank) AS items
FROM ranked WHERE rank <= 15 GROUP BY level1_id"""

ORACLES["topn_single_product"] = _with(
    "part_plays",
    "part_films",
    films=_FILM_NAMES,
    ranked=f"""SELECT f.content_id, content_name, count(*) AS views,
       row_number() OVER (ORDER BY count(*) DESC, f.content_id) AS rank, count(*) OVER () AS n
FROM part_plays p JOIN films f ON CAST(p.content_id AS BIGINT) = f.content_id WHERE {_CINEMA} GROUP BY 1, 2""",
    listed="SELECT *, row_number() OVER (PARTITION BY content_name ORDER BY rank) AS nth FROM ranked WHERE rank <= 20 AND n > 20",
) + f"""
SELECT 'Topcontentlist_5_10001719' AS list_key, CAST(rank AS INT) AS rank, content_id AS item_id, views,
       {_top_json('content_id', 'rank', 'content_name', "''", "'10046284'")} AS payload
FROM listed WHERE nth = 1"""

ORACLES["topn_per_catalog"] = _with(
    "part_plays",
    "ott_elements",
    ranked="""SELECT catalog_id, movie_id AS content_id, movie_name, count(*) AS views,
       row_number() OVER (PARTITION BY catalog_id ORDER BY count(*) DESC, movie_id) AS rank
FROM part_plays p JOIN ott_elements e ON CAST(p.content_id AS BIGINT) = movie_id
WHERE play_type = '1' AND flag4 <> '' GROUP BY 1, 2, 3""",
) + f"""
SELECT 'Topcontentlist_3_' || catalog_id || '_0' AS list_key, CAST(rank AS INT) AS rank, content_id, views,
       {_item_json('content_id', 'views', 'movie_name', 'rank')} AS payload
FROM ranked WHERE rank <= 20"""

def _district(order: str) -> str:
    return _with(
        "customer_plays",
        "districts",
        "relation",
        "part_members",
        episodes=PART_EPISODES,
        views="""SELECT district, coalesce(series_id, CAST(p.content_id AS BIGINT)) AS item_id,
       CASE WHEN series_id IS NULL THEN 0 ELSE 1 END AS series_type,
       CAST(count(*) AS DOUBLE) / coalesce(n_episodes, 1) AS views
FROM customer_plays p JOIN districts d ON CAST(p.user_id AS BIGINT) = d.user_id
LEFT JOIN episodes e ON CAST(p.content_id AS BIGINT) = e.content_id GROUP BY 1, 2, 3, n_episodes""",
        ranked=f"""SELECT v.*, content_name, level1_id, row_number() OVER (PARTITION BY district, v.series_type, level1_id
       ORDER BY {order} DESC, item_id) AS rank
FROM views v JOIN relation r ON v.item_id = r.content_id""",
    )


_DISTRICT_KEY = "district || '_5_' || series_type || '_' || level1_id AS list_key, CAST(rank AS INT) AS rank, item_id"
ORACLES["topn_by_district"] = _district("views") + f"""
SELECT {_DISTRICT_KEY}, content_name, round(views, 9) AS views FROM ranked WHERE rank <= 15"""
ORACLES["topn_by_district_whole_views"] = _district("floor(views)") + f"""
SELECT {_DISTRICT_KEY} FROM ranked WHERE rank <= 15"""

ORACLES["dedupe_names_keep_rank_gap"] = """
SELECT p_brand, CAST(rank AS INT) AS rank, p_partkey, p_name FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY rank) AS nth FROM (
    SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) a
  WHERE rank <= 30) b
WHERE nth = 1"""

# Contents that share attributes: all pairs of each group

_ATTRS = f"""SELECT content_id, title, {_KNOWN.format('genre')} AS genre,
       CAST(split_part({_KNOWN.format('create_time')}, ' ', 1) AS DATE) AS day,
       {_KNOWN.format('country')} AS country, series_type, level1_id, level2_id, level3_id, level4_id
FROM content WHERE {_KNOWN.format('genre')} IS NOT NULL"""

FILM_KEYS = ["level1_id", "genre", "series_type", "level2_id"]
FILM_KEYS_COARSE = FILM_KEYS[:3]
SCHOOL_KEYS = ["level1_id", "level2_id", "level3_id", "level4_id", "series_type"]
_NOT_SCHOOL = "level1_id <> '10001059'"
_FILM = f"{_NOT_SCHOOL} AND series_type <> '1'"
WITH_COUNTRY = f"{_FILM} AND day IS NOT NULL AND country IS NOT NULL"
WITHOUT = f"{_FILM} AND (day IS NULL OR country IS NULL)"
SERIES = f"{_NOT_SCHOOL} AND series_type = '1'"
SCHOOL = "level1_id = '10001059' AND level2_id <> '0'"


def _same(keys: Sequence[str]) -> str:
    return " AND ".join(f"t.{k} IS NOT DISTINCT FROM r.{k}" for k in keys)


def _hash(*parts: str, length: int | None = None) -> str:
    text = "md5(" + " || '|' || ".join(parts) + ")"
    return text if length is None else f"substr({text}, 1, {length})"


def _number(*parts: str) -> str:
    """A number of 60 bits, by a hash."""
    return f"CAST('0x' || {_hash(*parts, length=15)} AS BIGINT)"


def _positions(n: str, m: str, *seed: str) -> str:
    """``m`` different numbers below ``n``: for j from n - m on, a number up to j, or j if that is taken."""
    m = f"least({m}, {n})"
    drawn = f"{_number(*seed, 'i')} % ({n} - {m} + i + 1)"
    steps = f"list_transform(range({m}), lambda i: CASE WHEN i = 0 THEN [{drawn}] ELSE [{n} - {m} + i, {drawn}] END)"
    take = "list_append(taken, CASE WHEN list_contains(taken, x[2]) THEN x[1] ELSE x[2] END)"
    return f"CASE WHEN {m} > 0 THEN list_reduce({steps}, lambda taken, x: {take}) ELSE [] END"


def _drawn_pairs(items: str, targets: str, keys: Sequence[str], k: int, seed: str, title: str, shown: Sequence[str]) -> str:
    """Pairs (t_..., rec_...) that draws choose, and whether the target's group offers ``k`` items (``whole``).

    Items of a group are numbered by title; a draw leaves out the numbers of the target's title.
    """
    by = ", ".join(keys)
    name = f"coalesce('=' || {title}, '#' || content_id)"
    target = ", ".join(f"t.{c} AS t_{c}" for c in ["content_id", title, *keys])
    return f"""SELECT {target}, r.content_id AS rec_content_id, {', '.join(f'r.{c} AS rec_{c}' for c in shown)}, whole
FROM (WITH named AS (SELECT *, {name} AS name FROM ({items}) i),
           placed AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5(name), name, content_id) - 1 AS place FROM named),
           groups AS (SELECT {by}, count(*) AS n FROM placed GROUP BY ALL),
           titles AS (SELECT {by}, name, min(place) AS low, count(*) AS own FROM placed GROUP BY ALL),
           ids AS (SELECT {by}, content_id, list(name) AS names FROM placed GROUP BY ALL),
           asked AS (SELECT t.*, n - coalesce(own, 0) AS free, coalesce(low, 0) AS low, coalesce(own, 0) AS own,
                            coalesce(len(list_filter(names, lambda x: x <> t.name)), 0) AS twins
                     FROM (SELECT *, {name} AS name FROM ({targets}) q) t JOIN groups r ON {_same(keys)}
                     LEFT JOIN titles s ON {_same(keys).replace('r.', 's.')} AND t.name = s.name
                     LEFT JOIN ids u ON {_same(keys).replace('r.', 'u.')} AND t.content_id = u.content_id)
      SELECT *, free - twins >= {k} AS whole, unnest({_positions('free', f'({k} + twins)', seed, 'content_id')}) AS drawn FROM asked) t
JOIN (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5(name), name, content_id) - 1 AS place
      FROM (SELECT *, {name} AS name FROM ({items}) i) j) r
ON {_same(keys)} AND r.place = t.drawn + CASE WHEN t.drawn >= t.low THEN t.own ELSE 0 END AND r.content_id <> t.content_id"""


def _related(where: str, keys: Sequence[str], k: int, since: str | None, draw: int | None = None) -> str:
    """Recommendations of the rows that satisfy ``where``: newest first, or drawn with a seed."""
    owner = "t_content_id, t_title, " + ", ".join(f"t_{key}" for key in keys)
    recent = f"r.day > DATE '{since}'" if since else "TRUE"
    target = ", ".join(f"t.{c} AS t_{c}" for c in ["content_id", "title", *keys])
    extra = [c for c in ["level1_id", "level2_id", "genre", "series_type"] if c not in keys]
    order = "rec_day DESC NULLS LAST, rec_content_id"
    if draw is None:
        pairs = f"""SELECT {target}, r.content_id AS rec_content_id, r.title AS rec_title, r.day AS rec_day
FROM g t JOIN g r ON {_same(keys)} AND t.content_id <> r.content_id AND t.title <> r.title WHERE {recent}"""
    else:
        pairs = _drawn_pairs(f"SELECT * FROM g r WHERE {recent}", "SELECT * FROM g", keys, k, f"'{draw}'", "title", ["title", "day"])
        turn = _hash(f"'{draw}'", "t_content_id", "rec_content_id")
        order = f"CASE WHEN whole THEN {turn} END, {order}"
    missing = "".join(f", NULL AS {c}" for c in extra)
    return f"""SELECT t_content_id AS content_id, {', '.join(f't_{key} AS {key}' for key in keys)}{missing},
       row_number() OVER (PARTITION BY {owner} ORDER BY p) AS rank, rec_content_id, rec_title, rec_day
FROM (
  SELECT *, row_number() OVER (PARTITION BY {owner}, rec_title ORDER BY p) AS nth
  FROM (WITH g AS (SELECT {', '.join(keys)}, content_id, title, max(day) AS day FROM attrs WHERE {where} GROUP BY ALL),
             pairs AS ({pairs})
        SELECT *, row_number() OVER (PARTITION BY {owner} ORDER BY {order}) AS p FROM pairs) f
  WHERE p <= {k}) d
WHERE nth = 1"""


def _pair_query(where: str, keys: Sequence[str], k: int, since: str | None, draw: int | None = None) -> str:
    return _with("content", attrs=_ATTRS, found=_related(where, keys, k, since, draw)) + """
SELECT content_id, level1_id, CAST(rank AS INT) AS rank, rec_content_id, rec_title, CAST(rec_day AS VARCHAR) AS rec_day
FROM found"""


TWO_YEARS, FIVE_YEARS = "2014-01-01", "2011-01-01"
ORACLES["content_same_country"] = _pair_query(WITH_COUNTRY, [*FILM_KEYS, "country"], 6, TWO_YEARS)
ORACLES["content_missing_attrs"] = _pair_query(WITHOUT, FILM_KEYS, 6, FIVE_YEARS)
ORACLES["content_series"] = _pair_query(SERIES, FILM_KEYS, 6, TWO_YEARS)
ORACLES["content_education"] = _pair_query(SCHOOL, SCHOOL_KEYS, 6, FIVE_YEARS)
ORACLES["content_random_sample"] = _pair_query(WITH_COUNTRY, [*FILM_KEYS, "country"], 6, TWO_YEARS, 42)

_OWNERS = """SELECT DISTINCT catalog_id AS content_id, catalog_id AS owner_id FROM part_members
UNION SELECT catalog_id, content_id FROM part_members"""


ORACLES["series_lists_for_episodes"] = _with(
    "content", "part_members", attrs=_ATTRS, told=_related(SERIES, FILM_KEYS, 6, TWO_YEARS), owners=_OWNERS
) + """
SELECT owner_id, s.content_id, level1_id, CAST(rank AS INT) AS rank, rec_content_id
FROM told s JOIN owners o ON s.content_id = o.content_id"""


def _box_lists(
    k: int,
    since: str | None,
    draw: int | None,
    keys: Sequence[str] = FILM_KEYS,
    attrs: str = _ATTRS,
    school: bool = False,
    film_more_than: int = 5,
    series_more_than: int = 5,
    by_type: bool = False,
) -> str:
    parts = {
        "same": _related(WITH_COUNTRY, [*keys, "country"], k, since, draw),
        "lacking": _related(WITHOUT, keys, k, since, draw),
        "told": _related(SERIES, keys, k, since, draw),
        "taught": _related(SCHOOL, SCHOOL_KEYS, k, since, draw),
    }
    kind = "series_type" if by_type else "'0'"
    steps = [("same", film_more_than), ("lacking", film_more_than), ("told", series_more_than)]
    if school:
        steps.append(("taught", film_more_than))
    else:
        del parts["taught"]
    selects = []
    for step, (name, gate) in enumerate(steps):
        owned = f"{name} s JOIN owners o ON s.content_id = o.content_id" if name == "told" else f"{name} s"
        owner = "owner_id" if name == "told" else "s.content_id"
        selects.append(
            f"""SELECT * FROM (SELECT {step} AS step, {owner} AS owner_id, s.content_id, level1_id, level2_id, genre,
       series_type, rank, rec_content_id, rec_title, count(*) OVER (PARTITION BY {owner}, s.content_id, level1_id,
       level2_id, genre, series_type) AS n FROM {owned}) x WHERE n > {gate}"""
        )
    key = f"owner_id || '_5_' || level1_id || '_' || {kind}"
    return _with(
        "content",
        "part_members",
        attrs=attrs,
        **parts,
        owners=_OWNERS,
        gated="\nUNION ALL\n".join(selects),
        keyed=f"""SELECT *, {key} AS list_key, dense_rank() OVER (PARTITION BY {key} ORDER BY step DESC, content_id DESC,
       level1_id DESC, level2_id DESC NULLS LAST, genre DESC NULLS LAST, series_type DESC) AS nth FROM gated""",
    ) + f"""
SELECT list_key, owner_id, CAST(rank AS INT) AS rank, rec_content_id, rec_title,
       {_item_json('rec_content_id', 'rank', 'rec_title')} AS payload
FROM keyed WHERE nth = 1"""


ORACLES["content_box_lists"] = _box_lists(15, TWO_YEARS, 42)
ORACLES["content_one_root"] = _box_lists(
    20, TWO_YEARS, 42, attrs=_ATTRS + " AND level1_id = '10046284'", film_more_than=0
)
ORACLES["content_earliest_form"] = _box_lists(
    15, None, None, FILM_KEYS_COARSE, school=True, film_more_than=0, series_more_than=0, by_type=True
)
ORACLES["content_five_years"] = _box_lists(15, FIVE_YEARS, None, school=True, film_more_than=0, series_more_than=0)

_TEXT = "string_agg(rec_content_id, '#' ORDER BY rank) AS items"
ORACLES["content_union_lists"] = _with(
    "content",
    "part_members",
    attrs=_ATTRS,
    same=_related(WITH_COUNTRY, [*FILM_KEYS, "country"], 15, TWO_YEARS, 42),
    lacking=_related(WITHOUT, FILM_KEYS, 15, TWO_YEARS, 42),
    told=_related(SERIES, FILM_KEYS, 15, TWO_YEARS, 42),
    owners=_OWNERS,
) + f"""
SELECT owner_id, items FROM (
SELECT content_id AS owner_id, level1_id, level2_id, genre, {_TEXT} FROM same GROUP BY ALL
UNION ALL
SELECT content_id, level1_id, level2_id, genre, {_TEXT} FROM lacking GROUP BY ALL
UNION ALL
SELECT owner_id, level1_id, level2_id, genre, {_TEXT}
FROM told s JOIN owners o ON s.content_id = o.content_id GROUP BY ALL) u"""


def _ott(school: bool) -> str:
    code = "CAST(catalog_id AS VARCHAR)" if school else "split_part(drama_type_id, ',', 1)"
    return _with(
        "ott_elements",
        rows=f"""SELECT *, {code} AS code FROM ott_elements
WHERE {_digits('type_id')} AND {_KNOWN.format('drama_type_id')} IS NOT NULL AND (type_id = '21') = {school}""",
        ranked="""SELECT t.movie_id, t.catalog_id, r.movie_id AS rec_movie_id, r.movie_name AS rec_movie_name,
       row_number() OVER (PARTITION BY t.movie_id, t.catalog_id ORDER BY r.movie_id) AS rank
FROM rows t JOIN rows r ON t.type_id = r.type_id AND t.code = r.code AND t.movie_id <> r.movie_id""",
    ) + f"""
SELECT movie_id || '_3_0_' || catalog_id AS list_key, CAST(rank AS INT) AS rank, rec_movie_id,
       {_item_json('rec_movie_id', 'rank', 'rec_movie_name')} AS payload
FROM ranked WHERE rank <= 15 AND (SELECT count(*) FROM ott_elements
  WHERE {_digits('type_id')} AND {_KNOWN.format('drama_type_id')} IS NOT NULL) > 100"""


ORACLES["content_first_code_pairs"] = _ott(False)
ORACLES["content_school_pairs"] = _ott(True)

# A film draws up to 20 from every catalogue it is in, keeps 20 of them and fills up from all films.
_WITH_CINEMA = _with(
    "cinema_members",
    "part_films",
    named="""SELECT DISTINCT catalog_id, m.content_id, content_name
FROM cinema_members m LEFT JOIN part_films f ON m.content_id = f.content_id""",
    pairs=_drawn_pairs("SELECT * FROM named", "SELECT * FROM named", ["catalog_id"], 20, "'42'", "content_name", ["content_name"]),
    picked=f"""SELECT *, row_number() OVER (PARTITION BY t_catalog_id, t_content_id
ORDER BY CASE WHEN whole THEN {_hash("'42'", 't_content_id', 'rec_content_id')} END, rec_content_id) AS q FROM pairs""",
    merged="SELECT DISTINCT t_content_id AS t, rec_content_id AS r FROM picked WHERE q <= 20",
    ranked=f"""SELECT *, row_number() OVER (PARTITION BY t ORDER BY {_hash("'42'", 't', 'r')}, r) AS rank FROM merged""",
    lists="SELECT t, r, rank, count(*) OVER (PARTITION BY t) AS n FROM ranked WHERE rank <= 20",
    own="SELECT t, r, rank, n FROM lists WHERE n > 2",
)
ORACLES["content_catalog_pairs"] = _WITH_CINEMA + """
SELECT t AS content_id, CAST(rank AS INT) AS rank, r AS rec_content_id FROM own"""


def _fills(k: int, barred: str, seed: str, lists: str, own: str) -> str:
    """(t, n, r, place) of the pool ids drawn for ``lists`` (t, n), without those in ``own`` (t, r); ``pool`` has r.

    A list draws what it lacks and as many more as it has ids that the draw may hit (``barred``).
    """
    return f"""SELECT t, n, r, row_number() OVER (PARTITION BY t ORDER BY {_hash(seed, 't', 'r')}, r) AS place
FROM (SELECT t, n, unnest({_positions('size', f'({k} - n + {barred})', seed, 't')}) AS drawn
      FROM ({lists}) l, (SELECT count(*) AS size FROM pool) c WHERE n < {k}) e
JOIN (SELECT r, row_number() OVER (ORDER BY r) - 1 AS at FROM pool) p ON p.at = e.drawn
WHERE NOT EXISTS (SELECT 1 FROM ({own}) w WHERE w.t = e.t AND w.r = p.r)"""


ORACLES["backfill_to_k"] = _WITH_CINEMA + f""",
pool AS (SELECT DISTINCT content_id AS r FROM cinema_members),
fills AS ({_fills(20, 'n + 1', "'42'", 'SELECT DISTINCT t, n FROM own', 'SELECT t, r FROM own UNION ALL SELECT DISTINCT t, t FROM own')})
SELECT t AS content_id, CAST(rank AS INT) AS rank, r AS rec_content_id, 'catalog' AS source FROM own
UNION ALL
SELECT t, CAST(n + place AS INT), r, 'pool' FROM fills WHERE n + place <= 20"""

ORACLES["web_two_level_pairs"] = _with(
    "web_catalog",
    "web_elements",
    rows=f"SELECT DISTINCT * FROM web_catalog WHERE {_digits('level1_id', 'level2_id', 'movie_id')}",
    merged="""SELECT DISTINCT t.level1_id, t.movie_id, r.movie_id AS rec_movie_id FROM rows t JOIN rows r
ON t.level1_id = r.level1_id AND t.level2_id = r.level2_id AND t.movie_id <> r.movie_id""",
    ranked="""SELECT *, row_number() OVER (PARTITION BY level1_id, movie_id ORDER BY rec_movie_id) AS rank,
       count(*) OVER (PARTITION BY level1_id, movie_id) AS n FROM merged""",
) + f"""
SELECT movie_id || '_7_' || level1_id || '_0' AS list_key, CAST(rank AS INT) AS rank, rec_movie_id,
       {_item_json('rec_movie_id', 'rank')} AS payload
FROM ranked WHERE rank <= 20 AND n > 20
  AND movie_id IN (SELECT movie_id FROM web_elements WHERE {_digits('resource_code')})"""

# Newest contents and live television

_NEW_ROWS = "SELECT DISTINCT level_id, content_id, content_name, series_type, resource_time FROM (" + " UNION ALL ".join(
    ["SELECT '0' AS level_id, content_id, content_name, series_type, resource_time FROM relation"]
    + [
        f"SELECT level{i}_id, content_id, content_name, series_type, resource_time FROM relation WHERE length(level{i}_id) > 1"
        for i in range(1, 7)
    ]
) + ") l"


def _newest(scope: str) -> str:
    return _with(
        "relation",
        rows=_NEW_ROWS,
        cut=f"""SELECT *, row_number() OVER (PARTITION BY level_id{scope} ORDER BY resource_time DESC, content_id) AS p FROM rows""",
        lists="""SELECT *, 'Newcontentlist_5_' || level_id || '_' || series_type AS list_key,
       row_number() OVER (PARTITION BY level_id, series_type ORDER BY p) AS rank FROM cut WHERE p <= 15""",
    )


ORACLES["newest_per_level"] = _newest("") + f"""
SELECT list_key, CAST(rank AS INT) AS rank, content_id,
       {_item_json('content_id', 'rank', 'content_name')} AS payload FROM lists"""
ORACLES["newest_per_level_and_type"] = _newest(", series_type") + """
SELECT list_key, CAST(rank AS INT) AS rank, content_id FROM lists"""

ORACLES["newest_ott"] = _with(
    "ott_elements",
    rows="""SELECT '0' AS level_id, 30 AS k, movie_id, movie_name, type_id, year FROM ott_elements UNION ALL
SELECT CAST(catalog_id AS VARCHAR), 15, movie_id, movie_name, type_id, year FROM ott_elements""",
    cut="""SELECT *, CASE WHEN type_id = '2' THEN '1' ELSE '0' END AS series_type,
       row_number() OVER (PARTITION BY level_id ORDER BY year DESC, movie_id) AS p FROM rows""",
    lists="""SELECT *, 'Newcontentlist_3_' || level_id || '_' || series_type AS list_key,
       row_number() OVER (PARTITION BY level_id, series_type ORDER BY p) AS rank FROM cut WHERE p <= k""",
) + f"""
SELECT list_key, CAST(rank AS INT) AS rank, movie_id, {_item_json('movie_id', 'rank', 'movie_name')} AS payload
FROM lists"""

ORACLES["channel_ranking"] = _with(
    "channels",
    "hourly_audience",
    rated="""SELECT channel, max(tv_rating) AS tv_rating FROM hourly_audience
WHERE date_time = DATE '2024-01-08' AND minute_time = '1200' GROUP BY 1""",
    ranked="""SELECT c.*, row_number() OVER (ORDER BY tv_rating DESC NULLS LAST, channel_id) AS rank
FROM channels c LEFT JOIN rated r ON service_id = channel""",
) + """
SELECT CAST(rank AS INT) AS rank, channel_id,
       '{"channelId":"' || channel_id || '","channelname":"' || channel_name || '","channelpic":"' || channel_image
       || '","rank":"' || rank || '"}' AS payload
FROM ranked WHERE rank <= 20"""

_TYPES = ", ".join(f"'{t}'" for t in PROGRAM_TYPES)
_CATEGORIES = " UNION ALL ".join(f"SELECT '{c}' AS category" for c in ["all", *PROGRAM_TYPES])
_LABEL = "lpad(CAST(minute // 60 AS VARCHAR), 2, '0') || lpad(CAST(minute % 60 AS VARCHAR), 2, '0')"
_CLOCK = "SELECT CAST(m AS INT) AS minute, TIMESTAMP '2024-01-15' + to_minutes(m) AS t FROM range(1440) r(m)"

ORACLES["minute_grid"] = _with(
    "schedule_rows",
    clock=_CLOCK,
    categories=_CATEGORIES,
    started="""SELECT CAST(hour(start_time) * 60 + minute(start_time) AS INT) AS minute, count(*) AS starts
FROM schedule_rows GROUP BY 1""",
) + f"""SELECT c.minute, {_LABEL.replace('minute', 'c.minute')} AS label, category, coalesce(starts, 0) AS starts
FROM clock c JOIN categories ON TRUE LEFT JOIN started s ON c.minute = s.minute"""


def _live(distinct: bool) -> dict[str, str]:
    group = "GROUP BY 1, 2, 3" if distinct else ""
    rating = "max(tv_rating) AS tv_rating" if distinct else "tv_rating"
    return {
        "clock": _CLOCK,
        "rated": """SELECT channel, minute_time, max(tv_rating) AS tv_rating FROM audience
WHERE date_time = DATE '2024-01-08' GROUP BY 1, 2""",
        "shown": f"""SELECT minute, channel_id, service_id, program_type FROM schedule_rows JOIN clock
ON start_time <= t AND start_time + to_minutes(minutes) > t
WHERE channel_id NOT IN ('ch3', 'ch7') AND wiki_title <> '广告'""",
        "graded": f"""SELECT s.*, tv_rating FROM shown s LEFT JOIN rated r
ON service_id = channel AND {_LABEL} = minute_time""",
        "placed": f"""SELECT minute, 'all' AS category, channel_id, {rating} FROM graded {group}
UNION ALL SELECT minute, program_type, channel_id, {rating} FROM graded WHERE program_type IN ({_TYPES}) {group}""",
        "live": """SELECT *, row_number() OVER (PARTITION BY minute, category
       ORDER BY tv_rating DESC NULLS LAST, channel_id) AS rank FROM placed""",
    }


ORACLES["live_channels_by_minute"] = _with("schedule_rows", "audience", **_live(True)) + """
SELECT minute, category, CAST(rank AS INT) AS rank, channel_id FROM live"""


def _choices(tests: dict[str, str], library: str, fields: str = "media_id") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS category, {fields} FROM {library} WHERE {t}" for c, t in tests.items())


# The rules of fillers, as in the library.
_SPORT = " AND ".join(f"tags NOT LIKE '%{w}%'" for w in ["爱情", "纪实", "恐怖", "惊悚"])
LIBRARY_TESTS = {
    "电视剧": "mtype = 'tv'",
    "电影": "mtype = 'movie'",
    "少儿": "mtype = 'cartoon'",
    "综合": "mtype = 'variety'",
    "体育": f"mtype <> 'cartoon' AND mtype <> 'tv' AND (plots LIKE '%运动%' OR tags LIKE '%运动%') AND {_SPORT}",
    "科教": "tags LIKE '%科教%' AND mtype = 'variety'",
    "财经": "mtype <> 'cartoon' AND (plots LIKE '%证券%' OR adword LIKE '%股市%' OR plots LIKE '%股市%' OR plots LIKE '%房地产%')",
    "娱乐": "mtype = 'variety' AND tags NOT LIKE '%纪实%' OR (tags LIKE '%纪实%' AND tags LIKE '%真人秀%')",
    "all": "mtype = 'variety'",
}
CATALOGUE_TESTS = {
    "电视剧": "ptype = '电视剧' AND year = 2015",
    "电影": "type = 0 AND ptype = '电影' AND year = 2015",
    "少儿": "ptype = '少儿' AND category_item_code <> ''",
    "综合": "type = 0 AND ptype = '纪实' AND year = 2015",
    "体育": "type = 0 AND ptype = '体育' AND big_image <> '' AND category_item_code <> ''",
    "科教": "type = 0 AND tags LIKE '%自然%' AND big_image <> '' AND year = 2015",
    "财经": "type = 0 AND ptype = '财经' AND big_image <> '' AND year = 2015",
    "娱乐": "type = 0 AND ptype = '娱乐' AND big_image <> '' AND year = 2015",
    "all": "type = 0 AND ptype = '纪实' AND year = 2015",
}
ORACLES["filler_choices"] = _with("film_library") + _choices(LIBRARY_TESTS, "film_library")
ORACLES["filler_choices_catalogue"] = _with("programme_catalogue") + _choices(CATALOGUE_TESTS, "programme_catalogue")


def _fields_json(fields: dict[str, str]) -> str:
    texts = [f"""'"{name}":"' || coalesce(CAST({column} AS VARCHAR), '') || '"'""" for name, column in fields.items()]
    return "'{' || " + " || ',' || ".join(texts) + " || '}'"


def _minute_lists(library: str, tests: dict[str, str], target: int, distinct: bool, fields: dict[str, str]) -> str:
    columns = ", ".join(fields.values())
    return _with(
        "schedule_rows",
        "audience",
        library,
        **_live(distinct),
        categories=_CATEGORIES,
        grid="SELECT minute, category FROM clock JOIN categories ON TRUE",
        pool=_choices(tests, library, columns),
        channels="""SELECT minute, category, count(*) AS n_live,
       string_agg('"' || channel_id || '"', ',' ORDER BY rank) AS names FROM live GROUP BY 1, 2""",
        sized="""SELECT g.*, coalesce(n_live, 0) AS n_live, coalesce(names, '') AS names
FROM grid g LEFT JOIN channels c ON g.minute = c.minute AND g.category = c.category""",
        numbered="""SELECT *, row_number() OVER (PARTITION BY category ORDER BY media_id) - 1 AS place,
       count(*) OVER (PARTITION BY category) AS size FROM pool""",
        drawn=f"""SELECT minute, category, n_live, unnest({_positions('size', f'({target} - n_live)', "'42'", 'minute', 'category')}) AS place
FROM sized JOIN (SELECT DISTINCT category, size FROM numbered) p USING (category) WHERE n_live < {target}""",
        fillers=f"""SELECT minute, category, string_agg({_fields_json(fields)}, ','
       ORDER BY {_hash("'42'", 'minute', 'category', 'media_id')}) AS vods
FROM drawn JOIN numbered USING (category, place) GROUP BY 1, 2""",
    ) + f"""
SELECT {_LABEL.replace('minute', 's.minute')} || '_' || s.category AS list_key, CAST(n_live AS INT) AS n_live,
       '{{"rec_livelist":[' || names || '],"rec_vodlist":[' || coalesce(vods, '') || ']}}' AS payload
FROM sized s LEFT JOIN fillers f ON s.minute = f.minute AND s.category = f.category"""


# The published fields of fillers, as in the library.
ORACLES["live_minute_lists"] = _minute_lists(
    "film_library", LIBRARY_TESTS, 18, True, {"name_cn": "name", "mediaid": "media_id", "index": "ind", "p_pic": "image"}
)
ORACLES["live_minute_lists_catalogue"] = _minute_lists(
    "programme_catalogue",
    CATALOGUE_TESTS,
    6,
    False,
    {
        "categoryCode": "category_code",
        "categoryItemCode": "category_item_code",
        "categoryName": "category_name",
        "pCode": "media_id",
        "pType": "ptype",
        "pName": "name",
        "type": "type",
        "bigImage1": "big_image",
    },
)

ORACLES["channels_on_air_at_events"] = _with("schedule_rows") + """
SELECT event_id, count(s.channel_id) AS channels, count(DISTINCT program_type) AS types
FROM events e JOIN schedule_rows s ON start_time <= date_trunc('second', e.ts) AND start_time + to_minutes(minutes) > date_trunc('second', e.ts)
WHERE CAST(e.ts AS DATE) = DATE '2024-01-15' AND channel_id NOT IN ('ch3', 'ch7') AND wiki_title <> '广告'
GROUP BY 1"""

# Trees

_REACHED = """WITH RECURSIVE edges AS ({edges}), starts AS ({starts}), reached AS (
  SELECT content_id FROM edges WHERE catalog_id IN (SELECT catalog_id FROM starts WHERE parent_id = 9)
  UNION SELECT e.content_id FROM edges e JOIN reached r ON e.catalog_id = r.content_id)
""".format(edges=duck("tree_edges"), starts=duck("tree_parents"))

ORACLES["subtree_members"] = _REACHED + "SELECT DISTINCT content_id FROM reached"

ORACLES["plays_in_subtree"] = _with(
    "event_plays",
    "event_members",
    episodes=EVENT_EPISODES,
    counts=_counts(f"{_FREE} AND {_window(30)} AND content_id IN (SELECT CAST(content_id AS VARCHAR) FROM event_members)"),
) + _ROLLED

ORACLES["plays_in_subtree_indexed"] = ORACLES["plays_in_subtree"]

ORACLES["subtree_customer_plays"] = _REACHED + f""", customer_plays AS ({duck('customer_plays')})
SELECT CAST(user_id AS BIGINT) AS user_id, count(*) AS plays FROM customer_plays
WHERE CAST(user_id AS BIGINT) IN (SELECT content_id - 100000 FROM reached) GROUP BY 1"""

ORACLES["deep_subtree_members"] = f"""WITH RECURSIVE edges AS ({duck('deep_edges')}), reached AS (
  SELECT content_id FROM edges WHERE catalog_id IN (5, 19) AND catalog_id <> content_id
  UNION SELECT e.content_id FROM edges e JOIN reached r ON e.catalog_id = r.content_id)
SELECT DISTINCT content_id FROM reached"""

# Kept up to date by days

ORACLES["rolling_counts"] = _with("event_plays") + f"""
SELECT CAST(content_id AS BIGINT) AS content_id, count(*) AS plays FROM event_plays
WHERE {_digits('content_id')} AND {_window(10)} AND CAST(ts AS DATE) <> DATE '2024-01-25' GROUP BY 1"""

ORACLES["topn_films_rolling"] = _box_top(
    0,
    "Topcontentlist_5_10046284",
    "event",
    "SELECT content_id, max(content_name) AS content_name FROM event_films GROUP BY 1",
    EVENT_EPISODES,
    f"{_digits('content_id')} AND {_window(30)}",
)

ORACLES["series_completion_bitmaps"] = _with("event_plays", "event_members", episodes=EVENT_EPISODES) + f"""
SELECT CAST(user_id AS BIGINT) AS user_id, series_id, CAST(max(n_episodes) AS BIGINT) AS total,
       count(DISTINCT e.content_id) AS watched, round(count(DISTINCT e.content_id) / CAST(max(n_episodes) AS DOUBLE), 9) AS ratio
FROM event_plays p JOIN episodes e ON p.content_id = CAST(e.content_id AS VARCHAR) WHERE {_digits('user_id', 'p.content_id')} GROUP BY 1, 2"""

ORACLES["itemcf_in_steps"] = _similarity("rated_plays")

# Expansion and publishing

def _list_facts(counts: str, k: int, suffix: str, more_than: int = 0, names: str = "SELECT NULL AS content_id, NULL AS content_name") -> str:
    """The same facts from the counts alone: a list has the user's items, k of them at most, named or with a blank."""
    payload = _item_json("item_id", "''", "coalesce(content_name, ' ')")
    return f"""
, named AS (SELECT user_id, item_id, {payload} AS payload FROM ({counts}) x LEFT JOIN ({names}) y ON item_id = content_id),
sizes AS (SELECT user_id, count(*) AS n, string_agg(item_id, '#' ORDER BY item_id) AS ids,
                 string_agg(payload, '#' ORDER BY item_id) AS payloads FROM named GROUP BY 1)
SELECT user_id || '_{suffix}' AS list_key, least(n, {k}) AS listed, least(n, {k}) AS last_rank, least(n, {k}) AS different,
  CAST(0 AS BIGINT) AS wrong, CAST(0 AS BIGINT) AS rises, CASE WHEN n < {k} THEN ids END AS items, CASE WHEN n < {k} THEN payloads END AS payloads
FROM sizes WHERE least(n, {k}) > {more_than}"""


_PLAIN = "SELECT user_id, content_id AS item_id, plays FROM counts"
ORACLES["als_rerank_facts"] = _with(
    "event_plays", "event_members", "event_films", episodes=EVENT_EPISODES, counts=_counts(f"{_FREE} AND {_window(90)}")
) + _list_facts(_ROLLED, 20, "5_10046284_0", 10, "SELECT content_id, min(content_name) AS content_name FROM event_films GROUP BY 1")
ORACLES["als_rerank_older_facts"] = _with(
    "event_plays", "event_members", episodes=EVENT_EPISODES, counts=_counts(f"{_FREE} AND {_window(90)}")
) + _list_facts(_ROLLED, 20, "5_10046284_0")
ORACLES["als_rerank_ott_facts"] = _with(
    "event_plays", counts=_counts(f"play_type = '1' AND flag4 <> '' AND {_window(90)}")
) + _list_facts(_PLAIN, 15, "3_0")
ORACLES["als_list_facts"] = _with(
    "event_plays", "event_members", episodes=EVENT_EPISODES, counts=_counts(_window(90))
) + f"""
SELECT user_id, least(n, 15) AS listed, CASE WHEN n < 15 THEN ids END AS items
FROM (SELECT user_id, count(*) AS n, string_agg(item_id, '#' ORDER BY item_id) AS ids FROM ({_ROLLED}) x GROUP BY 1)"""
ORACLES["als_customers_facts"] = _with(
    "customer_plays", "part_members", episodes=PART_EPISODES, counts=_counts("TRUE", "customer_plays")
) + _list_facts(_ROLLED, 20, "5_10046284_0")
ORACLES["als_fit_facts"] = _with(
    "customer_plays", "part_members", episodes=PART_EPISODES, counts=_counts("TRUE", "customer_plays")
) + f"""
SELECT count(*) AS ratings, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, CAST(sum(plays) AS BIGINT) AS plays,
  CAST(0 AS BIGINT) AS other_products, CAST(0 AS BIGINT) AS no_numbers, TRUE AS follows_plays FROM ({_ROLLED}) x"""
ORACLES["cinema_rerank_facts"] = _with("customer_plays", counts=_counts(_CINEMA, "customer_plays")) + """
SELECT DISTINCT user_id || '_5_10001719_0' AS list_key, CAST(20 AS BIGINT) AS listed, CAST(20 AS BIGINT) AS last_rank, CAST(20 AS BIGINT) AS different,
  CAST(0 AS BIGINT) AS ranked_from_catalog, TRUE AS unseen
FROM counts"""


ORACLES["cinema_expand"] = _with(
    "customer_plays",
    "cinema_members",
    counts=_counts(_CINEMA, "customer_plays"),
    played="""SELECT user_id, content_id AS item_id,
       row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, content_id) AS rank FROM counts""",
    seen="SELECT * FROM played WHERE rank <= 20",
    home="SELECT content_id AS best, max(catalog_id) AS catalog_id FROM cinema_members GROUP BY 1",
    films="SELECT catalog_id, content_id, min(position) AS position FROM cinema_members GROUP BY 1, 2",
    users="SELECT user_id, catalog_id FROM seen LEFT JOIN home ON item_id = best WHERE rank = 1",
    unseen="""SELECT user_id, content_id AS r, row_number() OVER (PARTITION BY user_id ORDER BY position, content_id) AS rank
FROM users u JOIN films f ON u.catalog_id = f.catalog_id
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = f.content_id)""",
    own="SELECT * FROM unseen WHERE rank <= 20",
    sized="SELECT u.user_id AS t, count(r) AS n FROM users u LEFT JOIN own o ON u.user_id = o.user_id GROUP BY 1",
    pool="SELECT DISTINCT content_id AS r FROM cinema_members",
    fills=_fills(20, "n", "'42'", "SELECT * FROM sized", "SELECT user_id AS t, r FROM own"),
) + """
SELECT user_id, CAST(rank AS INT) AS rank, r AS item_id, 'catalog' AS source FROM own
UNION ALL SELECT t, CAST(n + place AS INT), r, 'pool' FROM fills WHERE n + place <= 20"""


def _user_items(low: int, high: int) -> str:
    return f"""SELECT list_key, rank, content_id FROM (
SELECT CAST(user_id AS BIGINT) AS list_key, CAST(content_id AS BIGINT) AS content_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, CAST(content_id AS BIGINT)) AS INT) AS rank
FROM event_plays WHERE {_digits('user_id', 'content_id')} AND {_window(high, low)}
GROUP BY user_id, content_id) x WHERE rank <= 15"""


ORACLES["publish_min_size"] = _with("event_plays", lists=_user_items(0, 5)) + """
SELECT * FROM lists WHERE list_key IN (SELECT list_key FROM lists GROUP BY 1 HAVING count(*) > 10)"""

ORACLES["publish_not_shrinking"] = _with(
    "event_plays",
    old=_user_items(5, 10),
    new=_user_items(0, 5),
    taken="""SELECT n.list_key FROM (SELECT list_key, count(*) AS c FROM new GROUP BY 1) n
LEFT JOIN (SELECT list_key, count(*) AS c FROM old GROUP BY 1) o ON n.list_key = o.list_key
WHERE n.c >= coalesce(o.c, 0)""",
) + """
SELECT * FROM new WHERE list_key IN (SELECT list_key FROM taken)
UNION ALL SELECT * FROM old WHERE list_key NOT IN (SELECT list_key FROM taken)"""

_TWO_WINDOWS = dict(old=_user_items(5, 10), new=_user_items(0, 5))
ORACLES["publish_lists"] = _with(
    "event_plays",
    **_TWO_WINDOWS,
    first="SELECT *, count(*) OVER (PARTITION BY list_key) AS n FROM old QUALIFY n > 3",
    second="SELECT *, count(*) OVER (PARTITION BY list_key) AS n FROM new QUALIFY n > 3",
    taken="""SELECT DISTINCT s.list_key FROM second s LEFT JOIN first f ON s.list_key = f.list_key WHERE s.n >= coalesce(f.n, 0)""",
) + """
SELECT list_key, rank, content_id FROM second WHERE list_key IN (SELECT list_key FROM taken)
UNION ALL SELECT list_key, rank, content_id FROM first WHERE list_key NOT IN (SELECT list_key FROM taken)"""



def _newest_run(where: str) -> str:
    lists = ORACLES["newest_per_level"]
    return "SELECT *, count(*) OVER (PARTITION BY list_key) AS n FROM (" + lists.replace(
        f"relation AS ({duck('relation')})", f"relation AS (SELECT * FROM ({duck('relation')}) r WHERE {where})"
    ) + ") l QUALIFY n > 9"


ORACLES["publish_newest_lists"] = f"""WITH early AS ({_newest_run("resource_time < '2014-01-01'")}), late AS ({_newest_run('TRUE')}),
taken AS (SELECT DISTINCT l.list_key FROM late l LEFT JOIN early e ON l.list_key = e.list_key WHERE l.n >= coalesce(e.n, 0))
SELECT list_key, rank, payload FROM late WHERE list_key IN (SELECT list_key FROM taken)
UNION ALL SELECT list_key, rank, payload FROM early WHERE list_key NOT IN (SELECT list_key FROM taken)"""

ORACLES["publish_to_stores"] = _with(
    "event_plays",
    **_TWO_WINDOWS,
    second="SELECT *, count(*) OVER (PARTITION BY list_key) AS n FROM new QUALIFY n > 5",
    kept="""SELECT list_key, rank, content_id FROM second
UNION ALL SELECT * FROM old WHERE list_key NOT IN (SELECT list_key FROM second)""",
) + """
SELECT CAST(list_key AS VARCHAR) AS list_key, rank, content_id, store FROM kept, (SELECT unnest([0, 1]) AS store) s"""

ORACLES["district_counts_bucketed"] = _with("customer_plays", "districts") + f"""
SELECT district, CAST(content_id AS BIGINT) AS content_id, count(*) AS plays FROM customer_plays p
JOIN districts d ON CAST(p.user_id AS BIGINT) = d.user_id WHERE {_digits('p.user_id', 'content_id')} GROUP BY 1, 2"""

ORACLES["topn_by_district_bucketed"] = ORACLES["topn_by_district"]

ORACLES["scan_id_ranges"] = """
SELECT * FROM (SELECT CAST(floor(pow(CAST(o_orderkey AS DOUBLE), 3) / 1000000) AS BIGINT) AS id, o_orderkey, o_custkey FROM orders) o
WHERE id >= 10 AND id < 2000000"""

ORACLES["payload_item"] = f"SELECT p_partkey, {_item_json('p_partkey', 'p_size', 'p_name')} AS payload FROM part"
ORACLES["payload_top_list"] = (
    "SELECT p_partkey, "
    + _top_json("p_partkey", "p_size", "p_name", "p_type", "CASE WHEN p_size > 9 THEN p_brand END")
    + " AS payload FROM part"
)
ORACLES["payload_channel"] = _with("channels") + """
SELECT service_id, '{"channelId":"' || channel_id || '","channelname":"' || channel_name || '","channelpic":"'
       || channel_image || '","rank":"' || service_id || '"}' AS payload FROM channels"""

ORACLES["pool_fill"] = _with(
    own="""SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS p FROM orders) x WHERE p <= 3""",
    heads="SELECT DISTINCT o_custkey AS t, n FROM own",
    pool="SELECT DISTINCT o_orderkey AS r FROM orders WHERE o_orderpriority = '1-URGENT'",
    placed=_fills(6, "n", "'7'", "SELECT * FROM heads", "SELECT o_custkey AS t, o_orderkey AS r FROM own"),
) + "SELECT t AS o_custkey, r AS o_orderkey FROM placed WHERE place <= 6 - n"

_LOG_LINES = """SELECT CASE WHEN event_id % 7 = 0 THEN array_to_string(f[1:6], ',') ELSE array_to_string(f, ',') END AS value
FROM (SELECT event_id, [CAST(event_id AS VARCHAR), CASE WHEN event_id % 5 = 0 THEN '"' ELSE '' END || event_type, 'x', CAST(user_id AS VARCHAR),
  '1', CAST(event_id % 97 AS VARCHAR), CAST(user_id AS VARCHAR), 'prod', '', 'a b', '"q"', CAST(user_id + 1 AS VARCHAR), 'end'] AS f FROM events)"""


def _log_columns(**positions: int) -> str:
    fields = ", ".join(f"f[{at + 1}] AS {name}" for name, at in positions.items())
    return f"SELECT {fields} FROM (SELECT string_split(value, ',') AS f FROM ({_LOG_LINES}))"


ORACLES["log_lines_xor"] = _log_columns(content_id=0, watch_seconds=5, user_id=11)
ORACLES["log_lines_vsp"] = _log_columns(content_id=5, user_id=6, product_key=7)
ORACLES["log_lines_ott"] = _log_columns(content_id=3, flag4=4, play_type=5, user_id=7)
ORACLES["rating_lines"] = """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS item_id, round(value, 6) AS rating
FROM events"""
ORACLES["completion_lines"] = """SELECT user_id, event_id AS series_id, CAST(10 AS BIGINT) AS total, event_id % 10 AS watched, CAST(0.5 AS DOUBLE) AS ratio
FROM events"""
