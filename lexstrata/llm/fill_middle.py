"""Fill-in-middle transformation: texts are cut into prefix, middle and suffix between units, and put in another order.

A unit is a run of letters A-Z or one other character. An Arrow-batched pandas UDF finds the ends of a text's units with one
regular expression and keeps them in a compact array; the hash of the document's id draws two numbers of units, whose ends are
looked up to slice the text. Nothing but the id and the text decides, so reruns and retried tasks agree.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = regex.compile(r"[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that stay as they are, and of the others that are put in the order suffix, prefix, middle.
PLAIN, SPM = 10, 20
SEED = "1:"

RESULT = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"


def unit_ends(text: str) -> array:
    """The end of every unit, in code points."""
    return array("I", (m.end() for m in UNIT.finditer(text)))


def draws(doc_id: str, seed: str = SEED) -> list[int]:
    """Four numbers below 2^32 from the hash of seed and id."""
    h = hashlib.sha256((seed + doc_id).encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def transformed(doc_id: str, text: str, plain: int = PLAIN, spm: int = SPM, seed: str = SEED) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, length of prefix and of middle (none if plain), and the output of one text."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= 100 - plain or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[low - 1] if low else 0, ends[high - 1] if high else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < spm else "psm"
    output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if form == "spm" else f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, a, b - a, output


def restored(output: str, form: str) -> str:
    """The text that an output was made of. A marker begins with its only `<` and no part of a cut text holds one, so the first of each in order is the marker."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at = output.index(second, len(first))
    end = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


def fill_in_middle(doc_id: Column, text: Column, plain: int = PLAIN, spm: int = SPM, seed: str = SEED) -> Column:
    """A struct of RESULT for every id and text."""

    @F.pandas_udf(RESULT)
    def cut(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for i, t in zip(ids, texts, strict=True):
            n, form, a, m, output = transformed(i or "", t or "", plain, spm, seed)
            rows.append((n, form, a, m, output, _sha(output), _sha(restored(output, form))))
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"], dtype=object)
        return out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return cut(doc_id.cast("string"), text)


def restore(output: Column, form: Column) -> Column:
    """The texts that outputs of known forms were made of; null for null."""

    @F.pandas_udf("string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None or f is None else restored(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output, form)


def forms(documents: DataFrame, **options) -> DataFrame:
    """doc_id and RESULT of every document, one row for each row of documents.

    A null text is empty: no units, plain. A null id draws as an empty one; rows that repeat an id draw the same numbers, and
    the same output where their texts agree. Texts are cut whole, however long: besides the text a task holds four bytes a
    unit. Only doc_id and text are read, so names of other columns cannot clash. No rows give none.
    """
    made = fill_in_middle(F.col("doc_id"), F.col("text"), **options)
    return documents.select("doc_id", made.alias("_made")).select("doc_id", "_made.*")


def transform(documents: DataFrame, **options) -> DataFrame:
    """documents with every text replaced by its output (null texts by an empty one); all other columns as they were."""
    return documents.withColumn("text", fill_in_middle(F.col("doc_id"), F.col("text"), **options)["output"])
