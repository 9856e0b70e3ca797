"""Packing into padded batches: length buckets with optimal boundaries, then batches of a token budget.

Texts longer than a sequence are cut into pieces, so the histogram of lengths has at most max_len + 1 bins whatever the
corpus; it is counted over all pieces and is all that reaches the driver. Dynamic programming over it finds the bucket
boundaries with the least padding in total; each bucket's pieces, in hash order, fill batches of
budget // boundary rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables
from .mixing import size_of
from .ranks import hex_digits, running

MAX_LEN = 2048
BUCKETS = 16
BUDGET = 1 << 15


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bucket boundaries (at most `buckets`, each a length that occurs) with the least sum of (boundary - length).

    With lengths l_1 < .. < l_n and counts cumulated to C, the last bucket (i, j] costs l_j (C_j - C_i) less a constant,
    so best[k][j] = l_j C_j + min over i of (best[k-1][i] - C_i l_j): the lower envelope of lines with falling slopes,
    asked at rising l_j. Each layer is linear in n.
    """
    lengths = sorted(x for x, c in histogram.items() if c)
    if not lengths:
        return []
    n, upto = len(lengths), [0]
    for x in lengths:
        upto.append(upto[-1] + histogram[x])
    best = [0] + [None] * n  # with no bucket, only nothing can be covered
    choices = []
    for _ in range(min(buckets, n)):
        lines: list[tuple[int, int, int]] = []  # slope, value at 0, index
        head, now, choice = 0, [None] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                m, b = -upto[j - 1], best[j - 1]
                while len(lines) - head >= 2 and (b - lines[-2][1]) * (lines[-2][0] - lines[-1][0]) <= (lines[-1][1] - lines[-2][1]) * (lines[-2][0] - m):
                    lines.pop()
                lines.append((m, b, j - 1))
            x = lengths[j - 1]
            while head + 1 < len(lines) and lines[head + 1][0] * x + lines[head + 1][1] <= lines[head][0] * x + lines[head][1]:
                head += 1
            if head < len(lines):
                now[j], choice[j] = x * upto[j] + lines[head][0] * x + lines[head][1], lines[head][2]
        best = now
        choices.append(choice)
    out, j = [], n
    for choice in reversed(choices):
        out.append(lengths[j - 1])
        j = choice[j]
    return out[::-1]


def pieces_of(documents: DataFrame, max_len: int = MAX_LEN, length: Column | None = None) -> DataFrame:
    """(doc_id, piece, length): every document cut into pieces of max_len tokens and a rest; an empty one is one empty piece."""
    sized = documents.select("doc_id", (size_of() if length is None else length).alias("size"))
    last = f"greatest(0, (size - 1) div {max_len})"
    return sized.withColumn("piece", F.explode(F.expr(f"sequence(0L, {last})"))).select("doc_id", "piece", F.expr(f"least({max_len}, size - piece * {max_len})").alias("length"))


def texts_of(documents: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """(row, doc_id, piece, length, text): the pieces with their words and the spaces before each. row tells rows that repeat an id apart."""
    space, word = r"[\\x20\\x09-\\x0D]", r"[^\\x20\\x09-\\x0D]"
    sized = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), size_of().alias("size"))
    short = sized.where(f"size <= {max_len}").select("row", "doc_id", F.lit(0).cast("long").alias("piece"), F.col("size").alias("length"), "text")
    cut = sized.where(f"size > {max_len}").withColumn("words", F.expr(f"regexp_extract_all(text, '({space}*{word}+)', 1)"))
    chunks = F.expr(f"transform(sequence(0L, (size - 1) div {max_len}), i -> array_join(slice(words, cast(i * {max_len} + 1 as int), {max_len}), ''))")
    long = cut.select("row", "doc_id", "size", F.posexplode(chunks).alias("piece", "text"))
    return short.unionByName(long.select("row", "doc_id", F.col("piece").cast("long").alias("piece"), F.expr(f"least({max_len}, size - piece * {max_len})").alias("length"), "text"))


def _placed(pieces: DataFrame, keys: list[str], buckets: int, budget: int) -> DataFrame:
    """keys, doc_id, piece, length of every piece, and where it goes."""
    rows = pieces.groupBy("length").count().collect()  # at most max_len + 1 rows
    ends = boundaries({r["length"]: r["count"] for r in rows}, buckets)
    columns = [*keys, "doc_id", "piece", "length"]
    if not ends:
        return pieces.select(*columns, *[F.lit(0).cast("long").alias(c) for c in ("bucket_len", "batch", "slot")])
    n = sum(r["count"] for r in rows)
    bucket = F.expr(f"element_at(filter(array({', '.join(f'{e}L' for e in ends)}), e -> e >= length), 1)")
    keyed = pieces.select(*columns).withColumn("bucket_len", bucket).withColumn("_h", F.hex(F.xxhash64(*keys, "doc_id", "piece")))
    keyed = keyed.withColumn("_h", F.lpad("_h", 16, "0")).withColumn("_cell", F.substring("_h", 1, hex_digits(n)))
    placed = running(keyed, ["bucket_len"], "_cell", ["_h", *columns], {"_at": F.lit(1).cast("long")})
    room = f"greatest(1L, {budget} div greatest(bucket_len, 1))"
    return placed.select(*columns, "bucket_len", F.expr(f"_at div {room}").alias("batch"), F.expr(f"_at % {room}").alias("slot"))


def pack(documents: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, piece, length (words), bucket_len (what its batch is padded to), batch (within the bucket), slot (within the batch).

    Every word of every document is in one piece. A batch has at most budget // bucket_len rows (one at least); only a
    bucket's last batch has fewer. Null texts are empty; repeated rows are pieces of their own; empty tables give none.
    """
    pieces = Tables(documents.sparkSession, "pack").put(pieces_of(documents, max_len), "pieces")
    return _placed(pieces, [], buckets, budget)


def pack_texts(documents: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """As pack(), with the text of every piece; (bucket_len, batch, slot) is a key. The pieces of a row that is there more than once
    are apart. Texts are placed by their rows' numbers and joined last, so they are moved once."""
    pieces = Tables(documents.sparkSession, "pack").put(texts_of(documents, max_len), "pieces")
    placed = _placed(pieces.drop("text"), ["row"], buckets, budget)
    return placed.join(pieces.select("row", "piece", "text"), ["row", "piece"]).drop("row")
