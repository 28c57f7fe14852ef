"""DuckDB text of the fixture views (same derivation as sources/views.py).

``with_views(sql, 'survey', ...)`` prefixes a query with the CTEs it needs,
so every oracle query is one self-contained statement over the driver's
pre-registered tables.
"""

from __future__ import annotations

BUCKET_SQL = "CAST(('0x' || substr(md5(CAST({id} AS VARCHAR)), 1, 8)) AS BIGINT) % 10000"
WORDS_SQL = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+')"


def bucket_sql(id_expr: str, seed: int | None = None, modulus: int = 10000) -> str:
    key = f"CAST({id_expr} AS VARCHAR)" if seed is None else f"('{seed}:' || CAST({id_expr} AS VARCHAR))"
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % {modulus})"


def words_sql(c: str) -> str:
    return f"coalesce(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+'), []::VARCHAR[])"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def dlist(c: str, sep: str) -> str:
    return f"array_to_string(list_sort(list(DISTINCT {c})), '{sep}')"


VIEWS: dict[str, str] = {}

VIEWS["survey_lines"] = f"""
SELECT l.l_orderkey AS k, count(*) AS nlines,
       min(l.l_quantity) AS min_qty, max(l.l_quantity) AS max_qty,
       {dlist('p.p_type', ', ')} AS types,
       {dlist("l.l_returnflag || ' ' || l.l_linestatus", ', ')} AS settings,
       {dlist('p.p_name', ' ')} AS names,
       min(p.p_type || ' ' || p.p_brand) AS drink,
       {dlist('r.r_name', ', ')} AS regions
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY l.l_orderkey"""

VIEWS["survey"] = """
SELECT o.o_orderkey AS id,
       CAST(li.nlines AS VARCHAR) AS complexity,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL
            WHEN o.o_orderkey % 3 = 0 THEN 'between ' || CAST(CAST(li.min_qty AS BIGINT) AS VARCHAR)
                                          || ' and ' || CAST(CAST(li.max_qty AS BIGINT) AS VARCHAR)
            WHEN o.o_orderkey % 3 = 1 THEN li.types
            ELSE CAST(CAST(o.o_totalprice / 10000 AS DECIMAL(12,2)) AS VARCHAR) END AS ingredients,
       li.settings AS setting,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
            WHEN o.o_orderkey % 5 = 0 THEN CAST(CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS VARCHAR) || '-'
                                          || CAST(CAST(floor(o.o_totalprice / 1000) AS BIGINT) + 5 AS VARCHAR) || ' dollars'
            ELSE '$' || CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
       CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE li.names END AS movie,
       li.drink AS drink,
       li.regions AS reminder,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderpriority END AS hotsauce,
       o.o_orderstatus AS label
FROM orders o LEFT JOIN survey_lines li ON o.o_orderkey = li.k"""

VIEWS["docs"] = "SELECT doc_id AS id, text, lang AS label FROM documents"
VIEWS["docs_quality"] = """
SELECT d.doc_id AS id, d.text, CAST(l.quality AS VARCHAR) AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
VIEWS["chat"] = "SELECT conv_id * 1000 + turn AS id, text, role AS label FROM conversations"
VIEWS["numbers"] = """
SELECT 'events' AS src, event_id AS id, props AS answer FROM events
UNION ALL
SELECT 'pages' AS src, page_id AS id, url AS answer FROM pages"""
VIEWS["vectors"] = """
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS VARCHAR) AS label FROM embeddings"""
VIEWS["measures"] = "SELECT event_id AS id, value AS x, event_type AS label FROM events"
VIEWS["basket_opts"] = f"""
SELECT o_custkey, {dlist('o_orderpriority', ', ')} AS options FROM orders GROUP BY o_custkey"""
VIEWS["baskets"] = """
SELECT c.c_custkey AS id, b.options, c.c_mktsegment AS label
FROM customer c LEFT JOIN basket_opts b ON c.c_custkey = b.o_custkey"""
VIEWS["scores"] = """
SELECT event_id AS c, event_type AS model, user_id % 8 AS feature, user_id % 3 AS feature_type, value AS score
FROM events"""

DEPENDS = {"survey": ["survey_lines"], "baskets": ["basket_opts"]}


def with_views(sql: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the named views (and extra CTEs)."""
    order: list[str] = []
    for n in names:
        for d in DEPENDS.get(n, []):
            if d not in order:
                order.append(d)
        if n not in order:
            order.append(n)
    # each is made once, however often the query reads it
    ctes = [f"{n} AS MATERIALIZED ({VIEWS[n]}\n)" for n in order]
    ctes += [f"{n} AS MATERIALIZED ({body}\n)" for n, body in (extra or [])]
    if not ctes:
        return sql
    return "WITH " + ",\n".join(ctes) + "\n" + sql


# --- number parsers (N1-N5) in DuckDB --------------------------------------

def _low(c: str) -> str:
    return f"lower({strip_sql(c)})"


def n1_sql(c: str) -> str:
    arr = f"regexp_extract_all({_low(c)}, '\\d+\\.\\d+|\\d+')"
    return (f"(list_sum(list_transform({arr}, lambda x: CAST(x AS DOUBLE))) / nullif(len({arr}), 0))")


def n2_sql(c: str) -> str:
    seps = f"len(regexp_extract_all({_low(c)}, '[,-]'))"
    words = f"len(regexp_extract_all({_low(c)}, '[\\p{{L}}\\p{{N}}_]+'))"
    return (f"coalesce({n1_sql(c)}, CASE WHEN {seps} >= {words} - 1 AND {words} > 1 "
            f"THEN CAST({words} AS DOUBLE) END)")


def n3_sql(c: str) -> str:
    ints = f"regexp_extract_all({c}, '\\d+')"
    mean = f"(list_sum(list_transform({ints}, lambda x: CAST(x AS DOUBLE))) / nullif(len({ints}), 0))"
    return (f"coalesce(CASE WHEN contains({c}, '-') OR contains({c}, 'to') THEN {mean} "
            f"ELSE CAST({ints}[1] AS DOUBLE) END, 0.0)")


def n4_sql(c: str) -> str:
    first = f"regexp_extract({c}, '(\\d+)', 1)"
    return f"(CASE WHEN {first} <> '' THEN CAST({first} AS DOUBLE) END)"


def n5_sql(c: str) -> str:
    return f"TRY_CAST(replace({c}, ',', '') AS DOUBLE)"


def options_sql(c: str) -> str:
    """Stripped, non-empty options of a comma list (NULL -> empty list)."""
    return (f"list_filter(list_transform(string_split(coalesce({c}, ''), ','), "
            f"lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')")
