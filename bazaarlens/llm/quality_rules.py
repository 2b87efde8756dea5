"""Quality rules: a table of thresholds compiled into one projection of text measures.

Measures and verdict are column expressions, evaluated without user functions and without a shuffle.

Edge cases: a null or blank text has no words and fails the length rule; repeated rows are judged one
by one; an empty table gives an empty result; columns of the input are kept, save those named like a
measure, which the measure replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.registry import query, table

SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
ENDS = (".", "!", "?", ":", ";", '"', "»", "”")

# Frequent function words of the languages in the corpus.
STOP_WORDS = (
    "the be to of and that have with in is it for was on as are by this from "
    "der die das und ist von zu den mit ein eine für auf des im "
    "le la les de des et un une que est pour dans en du qui par "
    "el los las y del se por con una para al no su"
).split()


@dataclass(frozen=True)
class Rule:
    """A text of at least ``words`` words passes if ``measure`` lies between ``least`` and ``most``; an absent bound doesn't count."""

    measure: str
    least: float | None = None
    most: float | None = None
    words: int = 0


RULES = (
    Rule("n_words", most=1_000_000),
    Rule("mean_word_chars", 2, 15),
    Rule("symbol_share", most=0.05),
    Rule("stop_words", least=2, words=30),
    Rule("dup_line_share", most=0.5),
    Rule("open_line_share", most=0.95, words=30),
)


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_words", "n_lines", "n_open_lines",
    "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "open_line_share",
)


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    plain = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(plain) > 0, F.split(plain, f"[{SPACE}]+")).otherwise(F.array().cast("array<string>"))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures that rules refer to."""
    kept = df.columns
    df = df.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    df = df.withColumns({"__words": words_of(F.col("__text"))})
    df = df.withColumns(
        {
            "__n": F.size("__words"),
            "__hash": F.transform("__words", lambda w: F.xxhash64(w)),
            "__lines": F.filter(F.split(F.col("__text"), "\n", -1), lambda line: line.rlike(f"[^{SPACE}]")),
        }
    )
    # a window's key: the five word hashes in order, read off five shifted copies of one array
    window = F.transform(
        F.sequence(F.lit(0), F.col("__n") - WINDOW),
        lambda i: F.xxhash64(*[F.get("__hash", i + k) for k in range(WINDOW)]),
    )
    df = df.withColumn("__keys", F.when(F.col("__n") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    # only texts with a repeated key sort their windows and look at neighbours
    repeated = F.size(F.array_distinct("__keys")) < F.size("__keys")
    df = df.withColumn(
        "__sorted",
        F.when(repeated, F.sort_array(F.transform("__keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))).otherwise(
            F.array().cast("array<struct<k:bigint,i:int>>")
        ),
    )
    twin = F.transform(
        F.col("__sorted"),
        lambda s, j: F.when(
            (s["k"] == F.get("__sorted", j - 1)["k"]) | (s["k"] == F.get("__sorted", j + 1)["k"]), s["i"]
        ),
    )
    df = df.withColumn("__starts", F.sort_array(F.filter(twin, lambda i: i.isNotNull())))
    covered = F.aggregate(
        F.transform(
            F.col("__starts"),
            lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get("__starts", j + 1) - s, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    df = df.withColumns(
        {
            "n_words": F.col("__n").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.regexp_count(F.col("__text"), F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": covered.cast("long"),
            "stop_words": F.size(F.array_intersect(F.transform("__words", lambda w: F.lower(w)), stop)).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_open_lines": F.size(F.filter("__lines", lambda line: ~F.substring(F.rtrim(line), -1, 1).isin(*ENDS))).cast("long"),
        }
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    df = df.withColumns(
        {
            "mean_word_chars": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "open_line_share": share("n_open_lines", "n_lines"),
        }
    )
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, *MEASURES])])


def passes(rules: tuple[Rule, ...]) -> Column:
    """One condition for a table of rules."""
    verdict = F.lit(True)
    for r in rules:
        if r.least is not None:
            verdict = verdict & ((F.col("n_words") < r.words) | (F.col(r.measure) >= r.least))
        if r.most is not None:
            verdict = verdict & ((F.col("n_words") < r.words) | (F.col(r.measure) <= r.most))
    return verdict


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the measures, ``base_failed`` and ``kept``."""
    df = measures(df, text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & passes(rules))


BASE_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _check_sql() -> str:
    bounds = []
    for r in RULES:
        bounds += [f"(n_words < {r.words} or {r.measure} >= {r.least})"] if r.least is not None else []
        bounds += [f"(n_words < {r.words} or {r.measure} <= {r.most})"] if r.most is not None else []
    share = "case when {1} > 0 then {0} / {1} else 0.0 end".format
    ends = ", ".join(f"'{e}'" for e in ENDS)
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""with d as (select row_number() over () row_id, doc_id, coalesce(text, '') body from documents),
    l as (select *, regexp_extract_all(body, '[^{SPACE}]+') words,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) lines from d),
    w as (select row_id, i, words[i:i + 4] win from (select row_id, words, unnest(generate_series(1, len(words) - 4)) i from l)),
    twice as (select row_id, i from (select *, count(*) over (partition by row_id, win) c from w) where c > 1),
    hit as (select row_id, count(distinct i + k) n from twice, (select unnest([0, 1, 2, 3, 4]) k) group by row_id),
    m as (select doc_id, len(words) n_words, length(array_to_string(words, '')) word_chars,
        len(regexp_extract_all(body, '{SYMBOLS}')) n_symbols, len(lines) - len(list_distinct(lines)) n_dup_lines,
        coalesce(hit.n, 0) n_repeat_words, len(lines) n_lines,
        len(list_intersect(list_distinct(list_transform(words, lambda x: lower(x))), [{stops}])) stop_words,
        len(list_filter(lines, lambda x: right(rtrim(x, ' '), 1) not in ({ends}))) n_open_lines
        from l left join hit using (row_id)),
    r as (select *, {share('word_chars', 'n_words')} mean_word_chars, {share('n_symbols', 'word_chars')} symbol_share,
        {share('n_dup_lines', 'n_lines')} dup_line_share, {share('n_open_lines', 'n_lines')} open_line_share,
        n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from m)
    select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols,
        n_dup_lines::bigint n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
        not base_failed and {' and '.join(bounds)} kept from r"""


@query("op10_quality_rules", _check_sql())
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict."""
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*BASE_COLUMNS)
