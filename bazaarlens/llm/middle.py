"""Fill-in-middle transformation: cut a text twice at token borders and move the middle to the end.

A token is a run of letters A-Z, a-z or any other single code point. One ``fullmatch`` of ``(token)*``
keeps the end of every repetition, so ``ends(1)`` gives their number and both offsets at once; the rest
is column expressions. Cuts and form follow from the id alone, so a retried task gives the same rows,
and nothing is shuffled. Texts beyond ``PART`` code points are matched in parts that end between tokens.

Edge cases: null counts as empty and, like texts that hold a tag, keeps form ``plain``; a row without id
is cut as if its id were the empty text; repeated rows give repeated results; an empty table gives an
empty result. Other columns are kept, unless a result column has their name.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.registry import query, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20  # of 100: texts left plain, and cut texts that begin with their suffix
TOKENS = regex.compile("([A-Za-z]+|[^A-Za-z])*+")
NO_LETTER = regex.compile("[^A-Za-z]")
PART = 1 << 20
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


def token_ends(text: str, part: int = PART) -> np.ndarray:
    """Where each token of ``text`` ends, in code points."""
    found, start = [np.zeros(0, np.int64)], 0
    while start < len(text):
        stop = min(start + part, len(text))
        if stop < len(text) and not NO_LETTER.match(text, stop - 1):
            border = NO_LETTER.search(text, stop)  # the run of letters goes on: end with it
            stop = border.start() if border else len(text)
        found.append(np.array(TOKENS.fullmatch(text, start, stop).ends(1), np.int64))
        start = stop
    return np.concatenate(found)


def _cuts():
    def cuts(texts: pd.Series, one: pd.Series, other: pd.Series) -> pd.DataFrame:
        rows = []
        for text, a, b in zip(texts, one, other):
            ends = token_ends(text)
            first, second = sorted((a % (len(ends) + 1), b % (len(ends) + 1)))
            rows.append((len(ends), ends[first - 1] if first else 0, ends[second - 1] if second else 0))
        return pd.DataFrame(rows, columns=["n", "first", "second"], dtype="int64")

    return F.pandas_udf(cuts, "n long, first long, second long")


def _draw(key: Column, group: int) -> Column:
    """The given 8-digit group, from 1, of the hexadecimal sha256 of the id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n`` tokens, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``."""
    cut = "cut"
    while cut in df.columns:
        cut += "_"
    whole, k, c = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.col(f"`{key}`"), F.col(cut)
    tagged = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    form = (
        F.when((whole == "") | tagged | (_draw(k, 3) % 100 >= PLAIN_FROM), "plain")
        .when(_draw(k, 4) % 100 < SUFFIX_FIRST_BELOW, "spm")
        .otherwise("psm")
    )
    prefix = F.substr(whole, F.lit(1), c.first.cast("int"))
    middle = F.substr(whole, (c.first + 1).cast("int"), (c.second - c.first).cast("int"))
    suffix = F.substr(whole, (c.second + 1).cast("int"))
    output = (
        F.when(form == "plain", whole)
        .when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    found = {
        "n": c.n,
        "form": form,
        "prefix_chars": F.when(form != "plain", c.first),
        "middle_chars": F.when(form != "plain", c.second - c.first),
        "output": output,
    }
    kept = [F.col(f"`{x}`") for x in df.columns if x not in RESULTS]
    return df.withColumn(cut, _cuts()(whole, _draw(k, 1), _draw(k, 2))).select(*kept, *(v.alias(name) for name, v in found.items()))


def restored(output: Column, form: Column) -> Column:
    """The text that gave ``output``. No part of a cut text holds a tag, so the first of each is the one put in."""
    tag = len(PREFIX)
    body = F.substr(output, F.lit(tag + 1))

    def parts(second: str) -> tuple[Column, Column, Column]:
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + tag + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + tag + 1)

    prefix, suffix, middle = parts(SUFFIX)
    own_suffix, own_prefix, own_middle = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(own_prefix, own_middle, own_suffix)).otherwise(output)
    )


SQL = r"""
with drawn as (
    select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as tokens
    from documents
), numbers as (
    select *, len(tokens) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
        ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
    from drawn
), cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
            when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, coalesce(array_to_string(tokens[1:a], ''), '') as prefix,
        coalesce(array_to_string(tokens[a + 1:b], ''), '') as middle, coalesce(array_to_string(tokens[b + 1:], ''), '') as suffix
    from cuts
)
select doc_id, n, form,
    case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""


@query("op11_fill_in_middle", SQL)
def fill_in_middle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cuts, with digests of the output and of the text rebuilt from it."""
    found = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
