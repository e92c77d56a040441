"""Page triage: score pages by keywords and keep those that look like price tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffloom.plans.profile import Profile

#: Shapes of code-like and price-like tokens in page text. A code-like token has a letter and a digit from its start to the line's end.
CODE_TOKEN = r"\b(?=[A-Za-z0-9\-_/.]{5,}\b)%s[A-Za-z0-9][A-Za-z0-9\-_/.]*\b"
LETTER_AHEAD, DIGIT_AHEAD = r"(?=.*[A-Za-z])", r"(?=.*\d)"
PRICE_TOKEN = r"\b\d{2,5}(?:\.\d+)?(?:\.-)?\b"
FALLBACK_PAGES = 30


def page_score(text: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of the keywords that occur in the text, each once."""
    low = F.lower(text)
    return sum((F.when(F.contains(low, F.lit(k)), w).otherwise(0) for k, w in weights.items()), F.lit(0))


def has_marker(text: Column, markers: list[str]) -> Column:
    low, found = F.lower(text), F.lit(False)
    for m in markers:
        found = found | F.contains(low, F.lit(m))
    return found


def code_tokens(text: Column) -> Column:
    """The number of code-like tokens, in time that grows with the text's length.

    A line's runs of token characters are taken from the last to the first.
    What letters and digits stand behind a run is known then, so a pattern only
    looks ahead within its run.
    """
    def line_count(line: Column) -> Column:
        runs = F.reverse(F.split(line, r"[^\p{L}\p{N}_\-/.]+"))
        start = F.struct(F.lit(False).alias("letter"), F.lit(False).alias("digit"), F.lit(0).alias("n"))

        def step(seen: Column, run: Column) -> Column:
            shapes = {(has_letter, has_digit): CODE_TOKEN % (("" if has_letter else LETTER_AHEAD) + ("" if has_digit else DIGIT_AHEAD)) for has_letter in (True, False) for has_digit in (True, False)}
            count = lambda *has: F.regexp_count(run, F.lit(shapes[has]))
            n = F.when(F.length(run) < 5, 0).when(seen["letter"] & seen["digit"], count(True, True)).when(seen["letter"], count(True, False)).when(seen["digit"], count(False, True)).otherwise(count(False, False))
            return F.struct((seen["letter"] | run.rlike("[A-Za-z]")).alias("letter"), (seen["digit"] | run.rlike("[0-9]")).alias("digit"), (seen["n"] + n).alias("n"))

        return F.aggregate(runs, start, step, lambda seen: seen["n"])

    return F.aggregate(F.transform(F.split(text, "\n"), line_count), F.lit(0), lambda a, n: a + n)


def signals(text: Column) -> tuple[Column, Column]:
    """Numbers of code-like and of price-like tokens."""
    return code_tokens(text), F.regexp_count(text, F.lit(PRICE_TOKEN))


def scored(pages: DataFrame, profile: Profile, weights: dict[str, int] | None = None) -> DataFrame:
    """Pages (any columns, text) with score, roles, codes, prices, has_code_word and has_price_word.

    A null text scores as an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    codes, prices = signals(text)
    marks = {role: has_marker(text, profile.page_markers(role)) for role in profile.synonyms}
    return pages.withColumns({
        "score": page_score(text, profile.keyword_weights() if weights is None else weights),
        "roles": sum((m.cast("int") for m in marks.values()), F.lit(0)),
        "codes": codes, "prices": prices, "has_code_word": marks["alias"], "has_price_word": marks["purchase"],
    })


def is_table_page(min_score: int = 2) -> Column:
    """The gate: score, words for code and price, and roles or tokens enough."""
    roles, codes, prices = F.col("roles"), F.col("codes"), F.col("prices")
    dense = (roles >= 3) | ((roles >= 2) & (codes >= 6) & (prices >= 6)) | ((codes >= 20) & (prices >= 20))
    return (F.col("score") >= min_score) & F.col("has_code_word") & F.col("has_price_word") & dense


def candidates(pages: DataFrame, profile: Profile, *, min_score: int = 2, weights: dict[str, int] | None = None, max_pages: int | None = None, target_page: int | None = None, fallback: int = FALLBACK_PAGES) -> DataFrame:
    """Candidate pages of each document (doc_id, page_idx, text): doc_id, page_idx, score.

    A document without any page that passes the gate gives its ``fallback``
    best pages by score, lower pages first. ``max_pages`` keeps a document's
    first candidates; ``target_page`` (from 1) then keeps that page alone. The
    candidates come in order of document and page.
    """
    rows = scored(pages, profile, weights).select("doc_id", "page_idx", "score", is_table_page(min_score).alias("passed"))
    doc = Window.partitionBy("doc_id")
    ranked = rows.withColumns({"any": F.max("passed").over(doc), "rank": F.row_number().over(doc.orderBy(F.desc("score"), "page_idx"))})
    chosen = ranked.where(F.col("passed") | (~F.col("any") & (F.col("rank") <= fallback))).select("doc_id", "page_idx", "score")
    if max_pages is not None:
        chosen = chosen.withColumn("n", F.row_number().over(doc.orderBy("page_idx"))).where(F.col("n") <= max_pages).drop("n")
    if target_page is not None:
        chosen = chosen.where(F.col("page_idx") == target_page - 1)
    return chosen.orderBy("doc_id", "page_idx")


def keyword_weights(synonyms: DataFrame, weights: DataFrame) -> DataFrame:
    """(keyword, weight): the greatest weight of each synonym over its roles, and of the roles' own names.

    ``synonyms`` are rows (role, synonym), ``weights`` rows (role, weight); a
    role without a weight counts 1. Synonyms are taken in lower case with
    single spaces; empty ones and weights below 1 give no keyword.
    """
    words = F.trim(F.regexp_replace(F.lower("synonym"), r"\s+", " "))
    own = synonyms.join(weights, "role", "left").select(words.alias("keyword"), F.coalesce("weight", F.lit(1)).alias("weight"))
    named = weights.select(F.col("role").alias("keyword"), "weight")
    return own.union(named).where("keyword <> ''").groupBy("keyword").agg(F.max("weight").alias("weight")).where("weight > 0")
