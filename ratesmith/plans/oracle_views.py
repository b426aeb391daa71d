"""DuckDB text of the fixture views and entity features, for the SQL oracle.

Each view is a named CTE body.  ``with_views(sql)`` prefixes a query with
the CTEs it mentions (and, transitively, theirs), so every oracle string is
self-contained over the driver's registered base tables.  This is an
independent formulation of the same rules the Spark code follows; only the
fixed constants (defaults, feature lists) are shared.
"""

from __future__ import annotations

import re

from ratesmith.functions.scalars import DEFAULT_AS_OF
from ratesmith.operators import features as FT

AS_OF_YEAR = int(DEFAULT_AS_OF[:4])

VIEWS: dict[str, str] = {}


def _view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


define_view = _view


def _ratings_raw(item_col: str) -> str:
    return f"""
    SELECT o.o_custkey AS user_id, l.{item_col} AS business_id,
           CAST(ceil(l.l_quantity / 10.0) AS DOUBLE) AS stars,
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def _split_views(prefix: str, raw: str) -> None:
    _view(f"{prefix}_ratings", f"""
    SELECT user_id, business_id,
           arg_max(stars, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, stars)) AS stars
    FROM {raw} GROUP BY user_id, business_id""")
    _view(f"{prefix}_val", f"""
    SELECT user_id, business_id, stars FROM {prefix}_ratings
    WHERE (user_id * 31 + business_id * 17) % 10 = 0
    UNION ALL SELECT CAST(-1 AS BIGINT), (SELECT min(business_id) FROM {prefix}_ratings), CAST(NULL AS DOUBLE)
    UNION ALL SELECT (SELECT min(user_id) FROM {prefix}_ratings), CAST(-1 AS BIGINT), CAST(NULL AS DOUBLE)
    UNION ALL SELECT CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST(NULL AS DOUBLE)""")
    _view(f"{prefix}_train_raw", f"""
    SELECT r.* FROM {raw} r WHERE NOT EXISTS (
      SELECT 1 FROM {prefix}_val v WHERE v.user_id = r.user_id AND v.business_id = r.business_id)""")
    _view(f"{prefix}_train", f"""
    SELECT r.* FROM {prefix}_ratings r WHERE NOT EXISTS (
      SELECT 1 FROM {prefix}_val v WHERE v.user_id = r.user_id AND v.business_id = r.business_id)""")


# dense split: business = supplier; sparse split: business = part
_view("f_ratings_raw", _ratings_raw("l_suppkey"))
_split_views("f", "f_ratings_raw")
_view("p_ratings_raw", _ratings_raw("l_partkey"))
_split_views("p", "p_ratings_raw")

_view("f_review", """
    SELECT l_suppkey AS business_id, CAST(ceil(l_quantity / 10.0) AS DOUBLE) AS stars,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 100 END AS useful,
           l_tax * 100 AS funny, CAST(l_linenumber AS DOUBLE) AS cool
    FROM lineitem""")

_view("f_user_stats", """
    SELECT user_id, avg(stars) AS average_stars, count(*) AS review_count
    FROM f_ratings_raw GROUP BY user_id""")
_view("f_user_orders", """
    SELECT o_custkey AS user_id,
           CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS useful,
           CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS funny,
           CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS cool,
           min(o_orderdate) AS first_order,
           array_to_string(list_sort(list_distinct(list(CAST(year(o_orderdate) AS VARCHAR)))), ',') AS years
    FROM orders GROUP BY o_custkey""")
_view("f_user", """
    SELECT s.user_id, s.average_stars, s.review_count, o.useful, o.funny, o.cool,
           s.user_id % 50 AS fans,
           strftime(o.first_order, '%Y-%m-%d') AS yelping_since,
           CASE WHEN s.user_id % 7 = 0 THEN 'None' ELSE o.years END AS elite,
           CASE WHEN s.user_id % 5 = 0 THEN 'None'
                ELSE array_to_string(list_transform(range(1, s.user_id % 5 + 1),
                                                    lambda i: CAST(s.user_id + i AS VARCHAR)), ',') END AS friends
    FROM f_user_stats s JOIN f_user_orders o ON o.user_id = s.user_id
    JOIN customer c ON c.c_custkey = s.user_id""")

_view("f_biz_stats", """
    SELECT business_id, avg(stars) AS stars, count(*) AS review_count
    FROM f_ratings_raw GROUP BY business_id""")
_view("f_biz_types", """
    SELECT l.l_suppkey AS business_id, list_sort(list_distinct(list(p.p_type))) AS types
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_suppkey""")
_view("f_business", """
    SELECT st.business_id, st.stars, st.review_count, st.business_id % 2 AS is_open,
           CASE WHEN st.business_id % 11 = 0 THEN NULL
                WHEN st.business_id % 13 = 0 THEN 'Unknown' ELSE n.n_name END AS city,
           r.r_name AS state,
           CASE WHEN st.business_id % 9 = 0 THEN NULL
                ELSE array_to_string(t.types, ', ') END AS categories,
           CAST(st.business_id % 4 AS BIGINT) AS attributes_count,
           CASE WHEN st.business_id % 10 = 0 THEN 'bad'
                ELSE CAST(s.s_acctbal / 1000 AS VARCHAR) END AS latitude,
           CASE WHEN st.business_id % 10 = 0 THEN 'bad' WHEN st.business_id % 10 = 5 THEN NULL
                ELSE CAST(-s.s_acctbal / 1000 AS VARCHAR) END AS longitude
    FROM f_biz_stats st JOIN supplier s ON s.s_suppkey = st.business_id
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN f_biz_types t ON t.business_id = st.business_id""")

for _name, _etype in (("f_photo", "view"), ("f_tip", "click")):
    _view(_name, f"""
    SELECT CASE WHEN event_id % 20 = 0 THEN NULL
                ELSE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS business_id
    FROM events WHERE event_type = '{_etype}'""")
    _view(_name + "_cnt", f"""
    SELECT business_id, count(*) AS {_name[2:]}_count FROM {_name}
    WHERE business_id IS NOT NULL GROUP BY business_id""")

for _col in ("city", "state"):
    _view(f"f_{_col}_codes", f"""
    SELECT v, CASE WHEN v = 'Unknown' THEN CAST(-1 AS BIGINT)
                   ELSE CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) END AS code
    FROM (SELECT DISTINCT coalesce({_col}, 'Unknown') AS v FROM f_business) d
    WHERE v <> 'None'""")


def _count_list(col: str) -> str:
    return f"CASE WHEN {col} = 'None' THEN 0 ELSE len(string_split({col}, ',')) END"


def _user_feat(log: bool) -> str:
    rc = "ln(1 + review_count)" if log else "CAST(review_count AS DOUBLE)"
    return f"""
    SELECT user_id,
           CAST(average_stars AS DOUBLE) AS user_avg_stars,
           {rc} AS user_review_count,
           CAST({_count_list('elite')} AS DOUBLE) AS user_elite_count,
           CAST({AS_OF_YEAR} - year(try_strptime(yelping_since, '%Y-%m-%d')) AS DOUBLE) AS user_years,
           CAST(useful AS DOUBLE) AS user_useful, CAST(funny AS DOUBLE) AS user_funny,
           CAST(cool AS DOUBLE) AS user_cool, CAST(fans AS DOUBLE) AS user_fans,
           CAST({_count_list('friends')} AS DOUBLE) AS user_friends_count
    FROM f_user"""


def _biz_feat(log: bool) -> str:
    rc = "ln(1 + b.review_count)" if log else "CAST(b.review_count AS DOUBLE)"
    return f"""
    SELECT b.business_id,
           CAST(b.stars AS DOUBLE) AS biz_stars,
           {rc} AS biz_review_count,
           CAST(b.attributes_count AS DOUBLE) AS biz_attributes_count,
           CAST(CASE WHEN b.categories IS NULL OR b.categories = '' THEN 0
                     ELSE len(string_split(b.categories, ',')) END AS DOUBLE) AS biz_categories_count,
           CAST(coalesce(cc.code, -1) AS DOUBLE) AS biz_city_code,
           CAST(coalesce(sc.code, -1) AS DOUBLE) AS biz_state_code,
           CAST(b.is_open AS DOUBLE) AS biz_is_open,
           coalesce(TRY_CAST(b.latitude AS DOUBLE), 0.0) AS biz_latitude,
           coalesce(TRY_CAST(b.longitude AS DOUBLE), 0.0) AS biz_longitude
    FROM f_business b
    LEFT JOIN f_city_codes cc ON cc.v = coalesce(b.city, 'Unknown')
    LEFT JOIN f_state_codes sc ON sc.v = coalesce(b.state, 'Unknown')"""


_view("f_user_feat", _user_feat(False))
_view("f_user_feat_log", _user_feat(True))
_view("f_biz_feat", _biz_feat(False))
_view("f_biz_feat_log", _biz_feat(True))
_view("f_rev_avg", """
    SELECT business_id,
           avg(coalesce(stars, 0.0)) AS rev_avg_stars, avg(coalesce(useful, 0.0)) AS rev_avg_useful,
           avg(coalesce(funny, 0.0)) AS rev_avg_funny, avg(coalesce(cool, 0.0)) AS rev_avg_cool
    FROM f_review GROUP BY business_id""")


def feature_select(pairs: str, feature_set: str, label: bool = True) -> str:
    """SELECT of a feature set over ``pairs`` with the lookup defaults."""
    cols = FT.FEATURE_SETS[feature_set]
    log = feature_set in FT.LOG_COUNT_SETS
    biz_def = FT.BUSINESS_DEFAULTS_ZERO if feature_set == "fs20" else FT.BUSINESS_DEFAULTS_CODED
    defaults = {**FT.USER_DEFAULTS, **biz_def, **FT.REVIEW_DEFAULTS, **FT.COUNT_DEFAULTS}
    src = {c: "u" for c in FT.USER_COLS}
    src.update({c: "b" for c in FT.BUSINESS_COLS})
    src.update({c: "r" for c in FT.REVIEW_COLS})
    src.update({"photo_count": "ph", "tip_count": "tp"})
    items = ["t.user_id", "t.business_id"]
    items += [f"coalesce(CAST({src[c]}.{c} AS DOUBLE), {float(defaults[c])!r}) AS {c}" for c in cols]
    if label:
        items.append("CAST(t.stars AS DOUBLE) AS stars")
    uf = "f_user_feat_log" if log else "f_user_feat"
    bf = "f_biz_feat_log" if log else "f_biz_feat"
    return f"""SELECT {', '.join(items)}
    FROM {pairs} t
    LEFT JOIN {uf} u ON u.user_id = t.user_id
    LEFT JOIN {bf} b ON b.business_id = t.business_id
    LEFT JOIN f_rev_avg r ON r.business_id = t.business_id
    LEFT JOIN f_photo_cnt ph ON ph.business_id = t.business_id
    LEFT JOIN f_tip_cnt tp ON tp.business_id = t.business_id"""


_IDENT = re.compile(r"\b([fp]_[a-z0-9_]+)\b")


def _deps(text: str) -> list[str]:
    return [n for n in dict.fromkeys(_IDENT.findall(text)) if n in VIEWS]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs, dependencies first."""
    views = dict(VIEWS)
    views.update(extra or {})
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for d in [n for n in dict.fromkeys(_IDENT.findall(views[name])) if n in views and n != name]:
            visit(d)
        order.append(name)

    for n in [n for n in dict.fromkeys(_IDENT.findall(sql)) if n in views]:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{views[n]}\n)" for n in order)
    return f"WITH {ctes}\n{sql}"
