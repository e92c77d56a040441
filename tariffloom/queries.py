"""Driver queries: each operator on the given tables, with its SQL beside it.

Inputs are written once, as SQL that both engines run; operators and oracle
then differ: DataFrame functions here, plain SQL there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.functions import codes, packs, prices, text
from tariffloom.operators import dedup, match, tables, triage
from tariffloom.plans.profile import Profile

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Dealt to as many tasks as a shuffle has: for small inputs of which each row is dear."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def given(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of an input query over the driver's tables."""
    import re

    used = {t: read(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", sql)}
    return spark.sql(re.sub(r"\b(" + "|".join(used) + r")\b", r"{\1}", sql), **used)


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- prices -----------------------------------------------------------------

PRICE_TEXTS = """
select id, case id % 12
    when 0 then cast(cast(p as decimal(12,2)) as string)
    when 1 then concat(cast(k as string), ',', lpad(cast(r as string), 3, '0'), '.50')
    when 2 then concat(cast(k as string), ' ', lpad(cast(r as string), 3, '0'))
    when 3 then concat(cast(i as string), '.-')
    when 4 then concat('Rs ', cast(i as string))
    when 5 then concat(cast(i as string), ' ', cast(i + 1 as string))
    when 6 then concat(cast(k as string), chr(10), lpad(cast(r as string), 3, '0'))
    when 7 then concat('  ', cast(i as string), '.  ')
    when 8 then concat(cast(i as string), ' A')
    when 9 then concat('-', cast(i as string))
    when 10 then concat(cast(k as string), ',,', lpad(cast(r as string), 3, '0'))
    else concat('Type ', cast(k as string), ' supply ', cast(i as string), ' 1/', cast(10 + id % 90 as string)) end as v
from (select p_partkey as id, p_retailprice as p, i, cast(floor(i / 1000.0) as bigint) as k, i % 1000 as r
      from (select p_partkey, p_retailprice, p_partkey * 37 % 90000 + 1000 as i from part) a) b
"""
PARSED = f"""
select id, v, case when regexp_matches(v, '[A-Za-z]') then null
    when n > 1 and regexp_matches(g, '^[0-9]{{1,3}}( [0-9]{{3}})+([.][0-9]+)?$') then try_cast(replace(g, ' ', '') as double)
    when n > 1 then null
    when regexp_matches(w, '^([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)([.][0-9]+)?$') then try_cast(replace(w, ',', '') as double) end as price
from (select *, len(regexp_extract_all(t, '[0-9]+(?:,[0-9]{{3}})*(?:[.][0-9]+)?')) as n,
             trim(regexp_replace(replace(t, ',', ''), '\\s+', ' ', 'g')) as g,
             trim(regexp_replace(replace(replace(t, ' ', ''), ',,', ','), '[.]-$', ''), '.') as w
      from (select *, trim(v, E' \\n\\t\\r') as t from ({PRICE_TEXTS}) i) a) b
"""


@query(f"select id, v, price from ({PARSED}) p")
def parse_price(spark, sf_dir):
    return given(spark, sf_dir, PRICE_TEXTS).select("id", "v", prices.parse_price(F.col("v")).alias("price"))


@query("""
select id, case id % 12 when 0 then cast(cast(p as decimal(12,2)) as double) when 1 then k * 1000 + r + 0.5 when 2 then big_r when 4 then i when 6 then big_r when 9 then i when 10 then big_r when 11 then big_pack end as trailing,
       cast(case when id % 12 = 11 then i end as double) as inline_price, case when id % 12 = 11 then concat('1/', cast(10 + id % 90 as varchar)) else '' end as inline_pack
from (select *, case when r >= 50 then r end as big_r, case when 10 + id % 90 >= 50 then 10 + id % 90 end as big_pack
      from (select p_partkey as id, p_retailprice as p, i, i // 1000 as k, i % 1000 as r from (select p_partkey, p_retailprice, p_partkey * 37 % 90000 + 1000 as i from part) a) b) c
""")
def text_prices(spark, sf_dir):
    """Trailing and inline prices of all twelve shapes; the SQL knows what was put into each."""
    rows = given(spark, sf_dir, PRICE_TEXTS)
    inline = prices.inline_price_and_pack(F.col("v"))
    return rows.select("id", prices.trailing_price(F.col("v")).alias("trailing"), inline["price"].alias("inline_price"), F.coalesce(inline["pack"], F.lit("")).alias("inline_pack"))


@query(f"""
select id, trim(p, E' \\n') as p0, regexp_matches(trim(p, E' \\n'), '^([0-9]+[.]?[0-9]*|[.][0-9]+)$') as ok
from (select id, replace(replace(replace(v, ',', ''), '/-', ''), '.-', '') as p from ({PRICE_TEXTS}) i) a
""")
def sheet_prices(spark, sf_dir):
    return given(spark, sf_dir, PRICE_TEXTS).select("id", prices.sheet_price(F.col("v")).alias("p0"), prices.is_sheet_price(F.col("v")).alias("ok"))


# --- codes ------------------------------------------------------------------

CODE_TEXTS = """
select p_partkey as id, case p_partkey % 14
    when 0 then concat('5ST', cast(p_partkey as string))
    when 1 then concat(cast(p_size as string), 'A')
    when 2 then concat('IP', cast(p_size as string))
    when 3 then concat(cast(p_size as string), 'X', cast(p_size + 3 as string), '/', cast(p_size as string))
    when 4 then concat('JB', cast(100 + p_size as string), 'X', cast(100 + p_size as string), 'X', cast(10 + p_size as string))
    when 5 then 'DOUBLEPOLE415V'
    when 6 then concat(cast(p_size as string), ' to ', cast(p_size + 4 as string))
    when 7 then concat(cast(10000 + p_partkey as string))
    when 8 then concat('socket-', cast(p_size % 10 as string))
    when 9 then concat(' ac ', cast(p_partkey as string), '/b_', cast(p_size as string))
    when 10 then concat(cast(p_size as string), '-', cast(p_size + 300 as string), 'W/75W')
    when 11 then concat(cast(p_size % 4 + 1 as string), ' POLE')
    when 12 then concat('5ST', cast(3000 + p_size as string), cast(p_size % 10 as string), ')')
    else p_brand end as v
from part
"""
REJECTS = " or ".join(
    f"regexp_matches(c, '{shape}')"
    for shape in (
        "^[0-9]+([.][0-9]+)?(MA|A|P|V|KV|W|KW|MW|HZ|KA)$", "^[0-9]+[- ]?(P|POLE|POLES)$", "^IP[0-9]{1,3}(/IK[0-9]{1,3})?$", "^[0-9]{1,4}X[0-9]{1,4}(/[0-9]{1,4})+$",
        "^[A-Z]{1,12}[0-9]{2,4}X[0-9]{2,4}(X[0-9]{2,4})+(-[0-9]{2,4})?$", "^[A-Z]{5,}[0-9]{2,4}K?V$",
        "^[0-9]+([.][0-9]+)?( *(TO|[-/]) *[0-9]+([.][0-9]+)?( *(MA|A|V|KV|W|KW|MW|VA|KVA|HZ))?)+ *(MA|A|V|KV|W|KW|MW|VA|KVA|HZ)?$", "^[0-9]+([.][0-9]+)? ?(TO|-|//) ?[0-9]+([.][0-9]+)?$",
    )
)
IS_CODE = f"(regexp_matches(c, '[A-Z]') and regexp_matches(c, '[0-9]') and regexp_matches(c, '^[A-Z0-9][A-Z0-9_/.-]{{2,}}$') and not ({REJECTS}))"


@query(f"""
select id, c as cleaned, {IS_CODE} as code, ({IS_CODE} or (regexp_matches(c, '^[0-9]{{5,12}}$'))) as numeric_code, s as sheet_code,
       (length(s) >= 4 and regexp_matches(s, '[A-Z]') and regexp_matches(s, '[0-9]')) as is_sheet_code, f as without_footnote
from (select id, upper(regexp_replace(trim(v), '\\s+', '', 'g')) as c, regexp_replace(upper(trim(v)), '[\\s_/-]+', '', 'g') as s,
             case when regexp_matches(trim(v), '^[A-Za-z0-9][A-Za-z0-9_/.-]*[0-9][)]$') then left(trim(v), length(trim(v)) - 2) else trim(v) end as f
      from ({CODE_TEXTS}) i) a
""")
def code_classes(spark, sf_dir):
    v = F.col("v")
    c = codes.clean_code(v)
    return given(spark, sf_dir, CODE_TEXTS).select("id", c.alias("cleaned"), codes.looks_like_code(c).alias("code"), codes.looks_like_code(c, numeric=True).alias("numeric_code"), codes.sheet_code(v).alias("sheet_code"), codes.is_sheet_code(v).alias("is_sheet_code"), codes.strip_footnote(v).alias("without_footnote"))


@query(f"""
select id, ({IS_CODE} or regexp_matches(c, '^[0-9]{{5,12}}$')) and not regexp_matches(c, '^[A-Z]{{3,}}(-[A-Z]{{2,}})*-[0-9]{{1,2}}$')
       and (case when regexp_matches(c, '^[0-9]+$') then length(c) >= 5
                 else not regexp_matches(c, '^[0-9]+([./-][0-9]+)+[A-Z]{{0,3}}$') and not regexp_matches(c, '^[0-9]+([.][0-9]+)?[A-Z]{{1,3}}([/-][0-9]+([.][0-9]+)?[A-Z]{{1,3}})+$') and length(regexp_replace(c, '[^0-9]', '', 'g')) >= 3 end) as strong
from (select id, upper(regexp_replace(trim(v), '\\s+', '', 'g')) as c from ({CODE_TEXTS}) i) a
""")
def strong_codes(spark, sf_dir):
    return given(spark, sf_dir, CODE_TEXTS).select("id", codes.is_strong_code(codes.clean_code(F.col("v")), numeric=True).alias("strong"))


SPACED = "select p_partkey as id, concat(lpad(cast(p_partkey * 7 % 9000 + 1000 as string), 4, '0'), ' ', lpad(cast(p_partkey * 13 % (case when p_partkey % 2 = 0 then 1000 else 100 end) as string), case when p_partkey % 2 = 0 then 3 else 2 end, '0')) as v from part"


@query(f"""
select id, case when length(r) = 3 and right(r, 1) in ('1', '2', '3') then l || left(r, 2) else l || r end as code
from (select id, split_part(v, ' ', 1) as l, split_part(v, ' ', 2) as r from ({SPACED}) i) a
""")
def spaced_codes(spark, sf_dir):
    return given(spark, sf_dir, SPACED).select("id", codes.spaced_code(F.col("v")).alias("code"))


# --- packs and headers ------------------------------------------------------

PACK_TEXTS = """
select l_orderkey * 10 + l_linenumber as id, l_partkey as p, case (l_orderkey + l_linenumber) % 8
    when 0 then cast(cast(l_quantity as int) as string)
    when 1 then concat(cast(l_linenumber as string), '/', cast(cast(l_quantity as int) as string))
    when 2 then concat(cast(cast(l_quantity as int) as string), ' Nos')
    when 3 then '-'
    when 4 then ''
    when 5 then concat('5ST', cast(l_partkey + 1000 as string))
    when 6 then concat(' ', cast(l_linenumber as string), chr(10), cast(cast(l_quantity as int) as string), '/10')
    else concat(cast(l_linenumber as string), ' ', cast(l_linenumber as string), ' ', cast(cast(l_quantity as int) as string)) end as v
from lineitem
"""
CLEAN = "case when regexp_matches(flat, '^[A-Za-z0-9_/.-]+$') then flat else '' end"


@query(f"""
select id, v, pack, case when pack = '' then 0 when regexp_matches(pack, '^5ST') then -3 when contains(pack, '/') then 3 when regexp_matches(pack, '^[0-9]+$') then 2 else 1 end as quality,
       regexp_matches(flat, '^[0-9]{{1,2}}( ?/ ?[0-9]{{1,2}})?$') as is_token
from (select id, v, flat, {CLEAN} as pack from (select id, v, trim(regexp_replace(v, '\\s+', ' ', 'g')) as flat from ({PACK_TEXTS}) i) a) b
""")
def pack_values(spark, sf_dir):
    v = F.col("v")
    return given(spark, sf_dir, PACK_TEXTS).select("id", "v", packs.clean_pack(v).alias("pack"), packs.pack_value_quality(packs.clean_pack(v)).alias("quality"), packs.is_pack_token(v).alias("is_token"))


@query(f"""
select id, cast(case when v = '' then 0 else sum(case when line is null then 0 when code then -4 else (case when regexp_matches(line, '[A-Za-z]') and not slash then -2 else 0 end) + (case when slash then 5 else 0 end) + (case when hint then 3 else 0 end) + (case when small and not slash then 2 else 0 end) end)
       + (case when sum(case when line is null or code then 0 else slash::int + hint::int + small::int end) >= 0.7 * count(line) then 4 else 0 end) end as int) as column_quality,
       count(*) filter (where line is not null and not code and (hint or small)) as pack_lines
from (select *, contains(line, '/') as slash, regexp_matches(line, '^5ST') as code,
             regexp_matches(line, '^([0-9]+ */ *[0-9]+|[0-9]+([.][0-9]+)? *([Nn]os?|pcs?))$') as hint,
             regexp_matches(line, '^[0-9]+$') and try_cast(line as int) between 1 and 100 as small
      from (select rid, id, v, unnest(case when regexp_matches(v, '^[0-9]+( [0-9]+)+$') then string_split(v, ' ') when v = '' then [null] else list_transform(string_split(v, chr(10)), lambda x: trim(x)) end) as line
            from (select *, row_number() over () as rid from ({PACK_TEXTS}) i) r) a) b
group by rid, id, v
""")
def pack_columns(spark, sf_dir):
    v = F.col("v")
    return given(spark, sf_dir, PACK_TEXTS).select("id", packs.pack_column_quality(v).alias("column_quality"), packs.pack_line_count(v).cast("bigint").alias("pack_lines"))


HEADERS = """
select p_partkey as id, case p_partkey % 7 when 0 then 'Cat.Nos' when 1 then concat('MRP*/', chr(10), 'Unit ', cast(p_size as string)) when 2 then 'Rated Current (A)'
    when 3 then 'Std. Pkg.** (Nos.)' when 4 then concat('Item Description ', p_type) when 5 then 'Unit Price ` /' else 'MW# Reference No' end as v from part
"""


def _sql_markers(role: str) -> str:
    return " + ".join(f"contains(' ' || h || ' ', ' {m} ')::int" for m in Profile().markers(role))


@query(f"""
select id, h as header, {_sql_markers('alias')} as alias_marks, {_sql_markers('purchase')} as purchase_marks, {_sql_markers('pack')} as pack_marks
from (select id, trim(regexp_replace(replace(lower(v), '`', ' inr '), '[^a-z0-9]+', ' ', 'g')) as h from ({HEADERS}) i) a
""")
def header_markers(spark, sf_dir):
    h, profile = text.normalize_header(F.col("v")), Profile()
    return given(spark, sf_dir, HEADERS).select("id", h.alias("header"), *(text.marker_count(h, profile.markers(r)).alias(f"{r}_marks") for r in ("alias", "purchase", "pack")))


# --- triage -----------------------------------------------------------------

PAGES = "select page_id as doc, page_id % 8 as doc_id, page_id as page_idx, html as text from pages"
WORDS = {"article": 2, "rate": 3, "nav": 1, "href": 1, "ad": 1}
TRIAGE = Profile({"alias": ["article"], "purchase": ["rate", "thand"], "particulars": ["title"], "pack": ["ul"]})
SCORE = " + ".join(f"(case when contains(lower(text), '{k}') then {w} else 0 end)" for k, w in WORDS.items())


@query(f"select page_idx, {SCORE} as score from ({PAGES}) p")
def triage_scores(spark, sf_dir):
    return given(spark, sf_dir, PAGES).select("page_idx", triage.page_score(F.col("text"), WORDS).alias("score"))


_MARK = {r: "(" + " or ".join(f"contains(lower(text), '{m}')" for m in TRIAGE.page_markers(r)) + ")" for r in TRIAGE.synonyms}
_ROLES = " + ".join(f"{m}::int" for m in _MARK.values())


@query(f"""
with s as (select doc_id, page_idx, {SCORE} as score, {_ROLES} as roles, {_MARK['alias']} and {_MARK['purchase']} as both_words from ({PAGES}) p),
     g as (select *, score >= 2 and both_words and roles >= 3 as passed from s),
     r as (select *, bool_or(passed) over (partition by doc_id) as any_passed, row_number() over (partition by doc_id order by score desc, page_idx) as n from g)
select doc_id, page_idx, score from r where passed or (not any_passed and n <= 3)
""")
def triage_candidates(spark, sf_dir):
    return triage.candidates(given(spark, sf_dir, PAGES), TRIAGE, weights=WORDS, fallback=3)


@query(f"""
with s as (select doc_id, page_idx, {SCORE} as score from ({PAGES}) p),
     r as (select *, row_number() over (partition by doc_id order by score desc, page_idx) as n from s),
     c as (select *, row_number() over (partition by doc_id order by page_idx) as k from r where n <= 30)
select doc_id, page_idx, score from c where k <= 5
""")
def triage_top_pages(spark, sf_dir):
    never = Profile({"alias": ["no such word"], "purchase": ["rate"], "particulars": ["title"], "pack": ["ul"]})
    return triage.candidates(given(spark, sf_dir, PAGES), never, weights=WORDS, max_pages=5)


TOKEN_TEXTS = """
select p_partkey as id, case p_partkey % 6
    when 0 then concat('AB', cast(400000 + p_partkey as string), ' ', cast(10000 + p_partkey as string), ' x')
    when 1 then concat(cast(10000 + p_partkey as string), ' ', cast(20000 + p_partkey as string))
    when 2 then 'Power supply'
    when 3 then concat(cast(10000 + p_partkey as string), chr(10), 'ABCDE')
    when 4 then concat('Power ', cast(10000 + p_partkey as string))
    else repeat(concat(' AB', cast(400000 + p_partkey as string), ' 120'), cast(p_partkey % 30 as int)) end as text
from part
"""


@query(f"select id, cast(case id % 6 when 0 then 2 when 4 then 1 when 5 then id % 30 else 0 end as int) as codes from ({TOKEN_TEXTS}) t")
def code_tokens(spark, sf_dir):
    """Tokens with a letter and a digit from their start to the line's end."""
    return given(spark, sf_dir, TOKEN_TEXTS).select("id", triage.code_tokens(F.col("text")).alias("codes"))


DENSE_PAGES = """
select p_partkey % 20 as doc_id, p_partkey as page_idx, concat('article rate', case when p_partkey % 3 = 0 then ' title' else '' end, case when p_partkey % 5 = 0 then ' ul' else '' end,
    repeat(concat(' AB', cast(400000 + p_partkey as string)), cast(p_partkey % 27 as int)), repeat(' 120', cast(p_partkey % 26 as int))) as text
from part
"""


@query(f"""
with p as (select doc_id, page_idx, 2 + (page_idx % 3 = 0)::int + (page_idx % 5 = 0)::int as roles, page_idx % 27 as n, page_idx % 26 as prices from ({DENSE_PAGES}) i),
     -- words of five letters before a digit on their line are code-like as well
     q as (select *, n + case when n + prices > 0 then 1 + (page_idx % 3 = 0)::int else 0 end as codes from p)
select doc_id, page_idx, cast(5 as int) as score from q where roles >= 3 or (roles >= 2 and codes >= 6 and prices >= 6) or (codes >= 20 and prices >= 20)
""")
def triage_dense_pages(spark, sf_dir):
    return triage.candidates(given(spark, sf_dir, DENSE_PAGES), TRIAGE, weights=WORDS)


@query(r"""
select doc_id, len(regexp_extract_all(text, '\b[0-9]{2,5}(?:[.][0-9]+)?(?:[.]-)?\b')) as price_tokens
from documents
""")
def price_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", triage.signals(F.col("text"))[1].cast("bigint").alias("price_tokens"))


@query("select page_id as page_number, length(trim(html, E' \\n\\t\\r')) as native_text_length from pages")
def page_manifest(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(F.col("page_id").alias("page_number"), F.length(text.strip(F.col("html"))).cast("bigint").alias("native_text_length"))


# --- deduplication ----------------------------------------------------------

PRICE_ROWS = """
select concat('AX', lpad(cast(l_partkey as string), 5, '0')) as alias, l_quantity * 5 as purchase,
    case when l_linenumber % 3 = 0 then 'd' else '' end as particulars, case l_linenumber % 4 when 0 then '1/10' when 1 then '10' when 2 then '' else 'x' end as pack,
    row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, l_extendedprice) as ord
from lineitem
"""
QUALITY = "(case when pack = '' then 0 when contains(pack, '/') then 3 when regexp_matches(pack, '^[0-9]+$') then 2 else 1 end + (particulars <> '')::int)"
_RATED = ", ".join(str(float(r)) for r in dedup.DEDUP_RATINGS)
def dedup_sql(rows: str, not_self: str = "true", footnotes: str = "", code_like: str = "false") -> str:
    """All layers over ``rows``, with conditions for what the input can hold."""
    return f"""
with k as (select *, {QUALITY} as q from ({rows}) i where {not_self}),
     a as (select alias, purchase, min(ord) as ord, first(particulars order by q desc, ord) as particulars, first(pack order by q desc, ord) as pack, max(q) as q from k group by alias, purchase),
     f as (select * from a {footnotes}),
     c as (select *, {code_like} as code_like, round(purchase, 2) in ({_RATED}) as rated from f),
     n1 as (select * from c qualify not rated or not bool_or(not rated) over (partition by alias)),
     n2 as (select * from n1 qualify not code_like or not bool_or(not code_like) over (partition by alias)),
     n3 as (select * from n2 qualify not (min(purchase) over (partition by alias) <= 120 and max(purchase) over (partition by alias) >= 150) or purchase = max(purchase) over (partition by alias)),
     r as (select *, row_number() over (partition by alias order by q desc, ord) as n from n3)
select alias, purchase, particulars, pack from r where n = 1
"""


def _dedup(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return dedup.deduplicate(given(spark, sf_dir, sql)).select("alias", "purchase", "particulars", "pack")


@query(dedup_sql(PRICE_ROWS))
def dedup_best_price(spark, sf_dir):
    return _dedup(spark, sf_dir, PRICE_ROWS)


FOOTNOTE_ROWS = """
select alias, purchase, '' as particulars, '' as pack, row_number() over (order by alias, purchase, s) as ord from (
    select cast(400000 + p_partkey as string) as alias, cast(p_size * 100 as double) as purchase, 0 as s from part
    union all select concat(cast(400000 + p_partkey as string), cast(p_size % 3 + 1 as string)), cast(p_size * 100 as double), 1 from part where p_partkey % 3 = 0
    union all select concat(cast(400000 + p_partkey as string), '9'), cast(p_size * 100 + 7 as double), 2 from part where p_partkey % 5 = 0
    union all select cast(p_size * 100 as string), cast(p_size * 100 as double), 3 from part where p_partkey % 7 = 0) u
"""


@query(dedup_sql(
    FOOTNOTE_ROWS, "try_cast(alias as double) is distinct from purchase",
    "where not (length(alias) >= 7 and exists (select 1 from a b where b.alias = left(a.alias, length(a.alias) - 1) and b.purchase = a.purchase))",
    f"(select count(*) from ({FOOTNOTE_ROWS}) x where x.alias = cast(cast(floor(f.purchase) as bigint) as varchar) and length(x.alias) >= 5) > 0",
))
def dedup_footnotes(spark, sf_dir):
    return _dedup(spark, sf_dir, FOOTNOTE_ROWS)


CHAIN_ROWS = """
select concat(cast(100000 + p_partkey as string), substr('9876', 1, n)) as alias, cast(p_size * 100 as double) as purchase, '' as particulars, '' as pack,
    p_partkey * 10 + case p_partkey % 4 when 0 then n when 1 then 4 - n when 2 then n * 3 % 5 else n * 2 % 5 end as ord
from part cross join (select 0 as n union all select 1 union all select 2 union all select 3 union all select 4) k where (p_partkey + n) % 7 <> 0
"""


@query(f"""
with c as (select *, length(alias) as l from ({CHAIN_ROWS}) i),
     f7 as (select a.alias, b.alias is not null as falls from c a left join c b on b.alias = left(a.alias, 6) and b.purchase = a.purchase where a.l = 7),
     f8 as (select a.alias, coalesce(b.ord > a.ord or not f.falls, false) as falls from c a left join c b on b.alias = left(a.alias, 7) and b.purchase = a.purchase left join f7 f on f.alias = b.alias where a.l = 8),
     f9 as (select a.alias, coalesce(b.ord > a.ord or not f.falls, false) as falls from c a left join c b on b.alias = left(a.alias, 8) and b.purchase = a.purchase left join f8 f on f.alias = b.alias where a.l = 9),
     f10 as (select a.alias, coalesce(b.ord > a.ord or not f.falls, false) as falls from c a left join c b on b.alias = left(a.alias, 9) and b.purchase = a.purchase left join f9 f on f.alias = b.alias where a.l = 10)
select alias, purchase from c where alias not in (select alias from (select * from f7 union all select * from f8 union all select * from f9 union all select * from f10) f where falls)
""")
def footnote_chains(spark, sf_dir):
    """Chains of up to five codes, each with one digit more, in four orders and with gaps."""
    return dedup.drop_footnotes(given(spark, sf_dir, CHAIN_ROWS)).select("alias", "purchase")


CODE_PRICES = """
select cast(20000 + p_partkey as string) as alias, cast(case when p_partkey % 4 = 0 then 20001 + p_partkey else p_size * 11 end as double) as purchase from part
"""


@query(f"select alias, purchase, cast(cast(purchase as bigint) as varchar) in (select alias from ({CODE_PRICES}) y) and purchase >= 10000 as code_like from ({CODE_PRICES}) x")
def code_like_prices(spark, sf_dir):
    rows = given(spark, sf_dir, CODE_PRICES)
    return dedup.code_like_prices(rows, rows)


@query(f"select alias, count(*) as prices, max(purchase) as top from ({PRICE_ROWS}) i group by alias")
def price_spread(spark, sf_dir):
    return given(spark, sf_dir, PRICE_ROWS).groupBy("alias").agg(F.count("*").alias("prices"), F.max("purchase").alias("top"))


MAPPED = "select p_size as page, case p_partkey % 3 when 0 then concat(cast(500000 + p_partkey as string), 'N') when 1 then cast(500000 + p_partkey as string) else concat('5', cast(500000 + p_partkey as string)) end as alias, cast(p_size * 10 + 200 as double) as purchase from part"
STREAM = "select p_size as page, concat(cast(500000 + p_partkey as string), case when p_partkey % 3 = 1 and p_partkey % 2 = 0 then '2' else '' end) as alias, cast(p_size * 10 + case when p_partkey % 5 = 0 then 100 else 200 end as double) as purchase from part"
_ALL_RATED = ", ".join(str(float(r)) for r in prices.RATINGS)


@query(f"""
with m as ({MAPPED}), s as ({STREAM})
select s.page, s.alias, s.purchase from s where round(purchase, 2) not in ({_ALL_RATED})
    and not exists (select 1 from m where m.page = s.page and m.alias = s.alias and m.purchase > s.purchase)
    and not exists (select 1 from m where m.page = s.page and m.purchase = s.purchase and (
        (length(s.alias) >= 7 and m.alias = left(s.alias, length(s.alias) - 1))
        or (m.alias <> s.alias and starts_with(m.alias, s.alias) and regexp_matches(substr(m.alias, length(s.alias) + 1), '^[A-Za-z]+$'))
        or (regexp_matches(m.alias, '^[0-9]+$') and length(m.alias) - length(s.alias) between 1 and 2 and ends_with(m.alias, s.alias))))
""")
def suppress_stream(spark, sf_dir):
    return dedup.suppress_stream(given(spark, sf_dir, MAPPED), given(spark, sf_dir, STREAM), ["page"]).select("page", "alias", "purchase")


# --- matching ---------------------------------------------------------------

EXTRACTED = """
select o_orderkey as ord, concat('Cust-', lpad(cast(o_custkey % 1000 as string), 4, '0')) as code, case when o_orderkey % 9 = 0 then 'n/a' else concat(cast(cast(floor(o_totalprice) as bigint) as string), '/-') end as price,
    case when o_orderkey % 11 = 0 then ' x ' else o_orderpriority end as description, cast(o_orderkey % 10 as double) / 10 as confidence from orders
"""
SHEET = "select c_custkey as row_id, case c_custkey % 5 when 0 then '' when 1 then concat('cust_', lpad(cast(c_custkey % 1500 as string), 4, '0')) when 2 then 'plain' else concat('CUST ', lpad(cast(c_custkey % 1200 as string), 4, '0')) end as Alias from customer"
_REASON = "case when not (length(nc) >= 4 and regexp_matches(nc, '[A-Z]') and regexp_matches(nc, '[0-9]')) then 'invalid_code' when not regexp_matches(np, '^[0-9]+[.]?[0-9]*$') then 'invalid_price' when confidence < 0.7 then 'low_confidence' when length(trim(description)) < 2 then 'missing_description' else 'accepted' end"
VALIDATED_SQL = f"select ord, nc as normalized_code, np as price, trim(description) as description, {_REASON} as review_reason from (select *, regexp_replace(upper(code), '[\\s_/-]+', '', 'g') as nc, trim(replace(replace(replace(price, ',', ''), '/-', ''), '.-', '')) as np from ({EXTRACTED}) i) a"
MATCHED_SQL = f"""
select row_id, Alias, alias_code_like, normalized_code, price from (
    select row_id, Alias, na, length(na) >= 4 and regexp_matches(na, '[A-Z]') and regexp_matches(na, '[0-9]') as alias_code_like
    from (select *, regexp_replace(upper(trim(Alias)), '[\\s_/-]+', '', 'g') as na from ({SHEET}) s) t) l
left join (select normalized_code, first(price order by ord) as price from ({VALIDATED_SQL}) v where review_reason = 'accepted' group by normalized_code) r on na = normalized_code
"""


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = match.validated(given(spark, sf_dir, EXTRACTED)).where("review_reason = 'accepted'")
    return match.match_sheet(given(spark, sf_dir, SHEET), accepted)


@query(VALIDATED_SQL)
def validate_rows(spark, sf_dir):
    return match.validated(given(spark, sf_dir, EXTRACTED)).select("ord", "normalized_code", "price", "description", "review_reason")


@query(MATCHED_SQL)
def match_sheet(spark, sf_dir):
    return _matched(spark, sf_dir).select("row_id", "Alias", "alias_code_like", "normalized_code", "price")


@query(f"select row_id, Alias from ({MATCHED_SQL}) m where alias_code_like and normalized_code is null")
def match_unmatched(spark, sf_dir):
    return match.unmatched(_matched(spark, sf_dir)).select("row_id", "Alias")


@query(f"select (select count(*) from orders) as candidate_rows, (select count(*) from ({VALIDATED_SQL}) v where review_reason = 'accepted') as accepted_rows, (select count(*) from ({VALIDATED_SQL}) v where review_reason <> 'accepted') as review_rows, (select count(normalized_code) from ({MATCHED_SQL}) m) as matched_rows, (select count(*) from pages) as total_pages")
def match_summary(spark, sf_dir):
    rows = match.validated(given(spark, sf_dir, EXTRACTED))
    good = F.col("review_reason") == "accepted"
    return match.summary(rows, rows.where(good), rows.where(~good), _matched(spark, sf_dir), read(spark, sf_dir, "pages"))


RESULTS = "select o_orderkey as page_number, case o_orderkey % 3 when 0 then 'success' when 1 then 'no_rows' else 'error' end as status, 'primary' as provider from orders"
FALLBACK = "select o_orderkey as page_number, 'success' as status, 'fallback' as provider from orders where o_orderkey % 2 = 0"


@query(f"select page_number, status, provider from ({RESULTS}) p where status = 'success' union all select f.* from ({FALLBACK}) f join ({RESULTS}) p using (page_number) where p.status <> 'success'")
def source_choice(spark, sf_dir):
    return match.chosen_source(given(spark, sf_dir, RESULTS), given(spark, sf_dir, FALLBACK))


# --- tables -----------------------------------------------------------------

TURNS = "select conv_id, turn, case when (conv_id + turn) % 3 = 0 then role end as mapping, text, (conv_id * 7 + turn) % 3 = 1 as continues from conversations"


@query(f"select conv_id, turn, last_value(mapping ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as inherited from ({TURNS}) t")
def carry_forward(spark, sf_dir):
    return tables.carry_forward(given(spark, sf_dir, TURNS), ["conv_id"], "turn", "mapping", "inherited").select("conv_id", "turn", "inherited")


@query(f"""
select conv_id, min(turn) as turn, string_agg(text, ' ' order by turn) as text, cast(count(*) as int) as n_rows
from (select *, sum(case when continues and n > 1 then 0 else 1 end) over (partition by conv_id order by turn) as b from (select *, row_number() over (partition by conv_id order by turn) as n from ({TURNS}) t) a) c group by conv_id, b
""")
def merge_continuations(spark, sf_dir):
    return tables.merge_continuations(given(spark, sf_dir, TURNS), ["conv_id"], "turn", "text", F.col("continues"))


@query("select event_id, cast(coalesce(sum((value > 50)::int) over (partition by user_id order by event_id rows between 1 following and 8 following), 0) as bigint) as following from events")
def following_signal(spark, sf_dir):
    return tables.following_count(read(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("value") > 50, 8, "following").select("event_id", "following")


@query("select event_id, bool_or(value < 5) over (partition by user_id, event_type order by event_id) as on_request from events")
def seen_on_request(spark, sf_dir):
    return tables.seen_before(read(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", F.col("value") < 5, "on_request").select("event_id", "on_request")


CELLS = """
select t, row_idx, c as col_idx, case c when 0 then concat('5ST', cast(1000 + p as string)) when 1 then cast(q as string) when 2 then concat(cast(n as string), '/', cast(q as string)) when 3 then cast(cast(floor(e) as bigint) as string) when 4 then concat('Switch ', f) else '' end as cell
from (select l_suppkey as t, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) as row_idx, l_partkey as p, cast(l_quantity as int) as q, l_linenumber as n, l_extendedprice as e, l_returnflag as f from lineitem) a
cross join (select 0 as c union all select 1 union all select 2 union all select 3 union all select 4 union all select 5) k
"""


@query(f"""
select t, col_idx, cast(sum((col_idx = 0)::int) as int) as codes, cast(sum((col_idx in (1, 3))::int) as int) as numbers, cast(sum((col_idx in (1, 2, 3))::int) as int) as packs, cast(sum((col_idx = 4)::int) as int) as texts,
       cast(sum((col_idx in (1, 3) and try_cast(cell as bigint) between 1 and 100)::int) as int) as small,
       cast(sum(case when col_idx = 4 then length(regexp_replace(cell, '[^A-Za-z]', '', 'g')) else 0 end) as int) as richness, cast(sum(case col_idx when 2 then 4 when 1 then 3 when 3 then 3 else 0 end) as int) as pack_strength
from ({CELLS}) i where cell <> '' group by t, col_idx
""")
def column_stats(spark, sf_dir):
    return tables.column_stats(spread(given(spark, sf_dir, CELLS)), ["t"])


@query(f"select t, col_idx from ({CELLS}) i where col_idx in (1, 3) group by t, col_idx having count(*) >= 3 and avg((try_cast(cell as bigint) between 1 and 100)::int) < 0.7")
def price_columns(spark, sf_dir):
    return tables.price_columns(tables.column_stats(spread(given(spark, sf_dir, CELLS)), ["t"])).select("t", "col_idx")


@query(f"select a.t, a.col_idx as code_col, b.col_idx as price_col, count(*) as n from ({CELLS}) a join ({CELLS}) b on a.t = b.t and a.row_idx = b.row_idx where a.col_idx = 0 and b.col_idx in (1, 3) group by 1, 2, 3")
def cooccurrence(spark, sf_dir):
    return tables.cooccurrence(given(spark, sf_dir, CELLS), ["t"])


@query(f"select a.t, a.col_idx as code_col, b.col_idx as pack_col, count(*) as n from ({CELLS}) a join ({CELLS}) b on a.t = b.t and a.row_idx = b.row_idx where a.col_idx = 0 and b.col_idx in (1, 2, 3) group by 1, 2, 3")
def pack_cooccurrence(spark, sf_dir):
    return tables.cooccurrence(given(spark, sf_dir, CELLS), ["t"], "pack")


@query("select p_partkey, list_sort(list_transform([3, 8, 12, 20, 33, 41], lambda c: struct_pack(d := abs(c - p_size), c := c)))[1].c as near_left, list_sort(list_transform([3, 8, 12, 20, 33, 41], lambda c: struct_pack(d := abs(c - p_size), s := case when c >= p_size then 0 else 1 end, c := c)))[1].c as near_right from part")
def nearest_column(spark, sf_dir):
    choices = F.array(*map(F.lit, (3, 8, 12, 20, 33, 41)))
    return read(spark, sf_dir, "part").select("p_partkey", tables.nearest(F.col("p_size"), choices).alias("near_left"), tables.nearest(F.col("p_size"), choices, prefer_right=True).alias("near_right"))


SWAP = "select l_suppkey as t, case when l_suppkey % 2 = 0 then l_quantity else l_extendedprice end as purchase, case when l_suppkey % 2 = 0 then l_extendedprice else l_quantity end as pack from lineitem"


@query(f"select t, count(purchase) as n_purchase, count(pack) as n_pack, count(purchase) >= 5 and count(pack) >= 5 and avg((purchase <= 200)::int) >= 0.7 and avg((pack >= 500)::int) >= 0.5 and max(pack) > 2 * max(purchase) as swap from ({SWAP}) i group by t")
def swapped_roles(spark, sf_dir):
    return tables.swapped_roles(given(spark, sf_dir, SWAP), ["t"], "purchase", "pack")


POINTS = "select user_id % 20 as page, event_id as word_id, cast(event_id * 37 % 1000 as double) as x, cast(event_id * 91 % 1400 as double) as y from events"
ANCHORS = "select user_id % 20 as page, event_id as anchor_id, cast(event_id * 37 % 1000 as double) as x, cast(event_id * 91 % 1400 as double) as y from events where event_id % 50 = 0"


@query(f"select w.page, anchor_id, word_id, w.x, w.y from ({ANCHORS}) a join ({POINTS}) w on a.page = w.page and abs(w.y - a.y) <= 22 and w.x between a.x - 10 and a.x + 260")
def band_join(spark, sf_dir):
    return tables.band_join(given(spark, sf_dir, ANCHORS), given(spark, sf_dir, POINTS), ["page"])


HORIZONTAL = """
select r as t, row_idx, c as col_idx, case when c = 0 then case row_idx % 4 when 0 then 'Module' when 1 then 'Reference No.' when 2 then 'Unit MRP' else 'Std. Pkg' end
    else case row_idx % 4 when 0 then concat(cast(c as string), 'M') when 1 then concat('5TG3', cast(r * 100 + row_idx * 10 + c as string)) when 2 then concat(cast(100 + r * 7 + row_idx + c as string), '.-') else '10' end end as cell
from (select s_suppkey as r from supplier) a cross join (select 0 as row_idx union all select 1 union all select 2 union all select 3 union all select 4 union all select 5 union all select 6 union all select 7) b
cross join (select 0 as c union all select 1 union all select 2 union all select 3) d
"""


@query(f"""
with h as ({HORIZONTAL})
select a.t, cast(a.row_idx // 4 as bigint) as block, a.col_idx, a.cell as alias, p.cell as purchase, k.cell as pack from h a join h p on a.t = p.t and a.col_idx = p.col_idx and p.row_idx = a.row_idx + 1 join h k on a.t = k.t and a.col_idx = k.col_idx and k.row_idx = a.row_idx + 2
where a.row_idx % 4 = 1 and a.col_idx > 0
""")
def unpivot_horizontal(spark, sf_dir):
    profile = Profile()
    h = text.normalize_header(F.col("cell"))
    marks = {r: text.marker_count(h, profile.markers(r)) for r in ("alias", "purchase", "pack")}
    top = F.greatest(*marks.values())
    role: Column = F.when(top > 0, F.when(marks["alias"] == top, "alias").when(marks["purchase"] == top, "purchase").otherwise("pack"))
    return tables.unpivot_blocks(given(spark, sf_dir, HORIZONTAL), ["t"], role)


STACKED = "select o_orderkey as id, concat('Ref', chr(10), 'AB', cast(o_custkey + 100 as string), chr(10), 'CD', cast(o_custkey + 200 as string)) as code_cell, concat(cast(cast(floor(o_totalprice) as bigint) as string), chr(10), case when o_orderkey % 4 = 0 then 'call' else cast(o_custkey as string) end) as price_cell from orders"


@query(f"""
select id, 0 as idx, split_part(code_cell, chr(10), 2) as alias, cast(split_part(price_cell, chr(10), 1) as double) as purchase from ({STACKED}) i
union all select id, 1, split_part(code_cell, chr(10), 3), try_cast(split_part(price_cell, chr(10), 2) as double) from ({STACKED}) i where split_part(price_cell, chr(10), 2) <> 'call'
""")
def zip_lines(spark, sf_dir):
    return tables.zip_lines(given(spark, sf_dir, STACKED), ["id"], "code_cell", "price_cell")


FRAGMENTS = "select conv_id as t, turn as row_idx, 0 as col_idx, case when turn % 2 = 0 then role else '' end as cell from conversations union all select conv_id, turn, 1, case when turn % 3 = 0 then ' ' else cast(length(text) as string) end from conversations"


@query(f"""
with f as (select t, row_idx, col_idx, trim(cell) as cell from ({FRAGMENTS}) i), n as (select t, row_idx, sum((cell <> '')::int) as n from f group by 1, 2), w as (select t from n group by t having count(*) >= 4 and sum((n <= 1)::int) >= 2)
select t, col_idx, string_agg(cell, chr(10) order by row_idx) as cell from f semi join w using (t) where cell <> '' group by 1, 2
""")
def collapse_table(spark, sf_dir):
    return tables.collapse_table(given(spark, sf_dir, FRAGMENTS), ["t"])


SPLIT_ROWS = "select user_id, event_id, case when event_id * 5 % 7 < 3 then 'c' end as code, case when event_id * 5 % 7 in (3, 4) then value + 60 end as purchase, event_id % 11 = 0 as text from events"


@query(f"""
with r as (select *, coalesce(purchase >= 50 and round(purchase, 2) not in ({_ALL_RATED}) and code is null and not text, false) as can from ({SPLIT_ROWS}) i),
     w as (select user_id, code is not null and purchase is null as needs, coalesce(lag(can) over o, false) as p1, coalesce(lag(can, 2) over o, false) as p2, coalesce(lead(can) over o, false) as n1, coalesce(lead(can, 2) over o, false) as n2 from r window o as (partition by user_id order by event_id)),
     v as (select user_id, cast(sum(case when not needs then 0 when p1 and not n1 then 2 when p1 and n1 and p2 then 1 else 0 end) as bigint) as before, cast(sum(case when not needs then 0 when n1 and not p1 then 2 when p1 and n1 and n2 then 1 else 0 end) as bigint) as after from w group by user_id)
select user_id, before, after, case when before >= 2 and before > after then 'previous' when after >= 2 and after > before then 'next' end as direction from v
""")
def price_direction(spark, sf_dir):
    return tables.price_direction(given(spark, sf_dir, SPLIT_ROWS), ["user_id"], "event_id")


STACKS = "select l_suppkey as t, l_orderkey * 100000 + l_partkey * 10 + l_linenumber as o, l_quantity as q, cast(l_partkey as double) as p from lineitem"


@query(f"""
select t, count(*) as n, case when count(*) < 2 then null when count(distinct q) < count(distinct p) then 'price_first' when count(distinct p) < count(distinct q) then 'alias_first' end as stack_order
from (select *, row_number() over (partition by t order by o, q, p) as n from ({STACKS}) i) a where n <= 8 group by t
""")
def stack_order(spark, sf_dir):
    rows = given(spark, sf_dir, STACKS).select("t", F.struct("o", "q", "p").alias("o"), F.array("q", "p").alias("stack"))
    return tables.stack_order(rows, ["t"], "o")


MATRICES = "select conv_id % 50 as page, conv_id * 100 + turn as ord, role as a, cast(length(text) % 10 as int) as b from conversations"


@query(f"select page, min(ord) as ord, a, b from ({MATRICES}) i group by page, a, b")
def distinct_matrices(spark, sf_dir):
    rows = given(spark, sf_dir, MATRICES).select("*", F.array(F.array("a", F.col("b").cast("string"))).alias("matrix"))
    return tables.keep_first_matrix(rows, ["page"], "matrix", "ord").select("page", "ord", "a", "b")


@query("""
select user_id, case when h.score >= 0 then h.idx end as header_idx from (
    select user_id, list_reduce(list_prepend({'idx': 0, 'score': -1}, scores[1:32]), lambda b, x: case when x.score > b.score + 100 or (x.score >= b.score and x.idx <= b.idx) then x else b end) as h
    from (select user_id, list_sort(list({'idx': cast(event_id % 1000 as int), 'score': cast(floor(value) as int)})) as scores from events group by user_id) a) b
""")
def header_rows(spark, sf_dir):
    """The fold with hysteresis over ordered scores."""
    scored = read(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct((F.col("event_id") % 1000).cast("int").alias("idx"), F.floor("value").cast("int").alias("score")))).alias("scores"))
    return scored.select("user_id", tables.header_fold(F.slice("scores", 1, 32)).alias("header_idx"))


SYNONYMS = "select distinct p_brand as role, concat('  ', upper(p_type), chr(10), ' Nr ') as synonym from part union all select 'pack', ' ' "
ROLE_WEIGHTS = "select distinct p_brand as role, cast(length(p_brand) + ascii(substr(p_brand, length(p_brand))) % 5 as int) as weight from part where p_size % 2 = 0 union all select 'zero', 0 union all select 'pack', 2"


@query(f"""
select keyword, max(weight) as weight from (
    select trim(regexp_replace(lower(synonym), '\\s+', ' ', 'g')) as keyword, coalesce(weight, 1) as weight from ({SYNONYMS}) s left join ({ROLE_WEIGHTS}) w using (role)
    union all select role, weight from ({ROLE_WEIGHTS}) v) k where keyword <> '' group by keyword having max(weight) > 0
""")
def keyword_weights(spark, sf_dir):
    return triage.keyword_weights(given(spark, sf_dir, SYNONYMS), given(spark, sf_dir, ROLE_WEIGHTS))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
