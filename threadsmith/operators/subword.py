"""Sub-word encoding (L2) with a published byte-pair vocabulary.

The vocabulary is a rank file (a line a token: its bytes in base64 and its rank), named by a path; none is trained here.
Texts are cut into pre-tokens in the JVM.  The pieces of every distinct pre-token are found once, by merging the
neighbours of lowest rank until none is left, and meet the texts through ``trainset.encode``."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from threadsmith.config import CorpusConfig

# Fixed value: the published pre-token pattern of byte-level vocabularies of this kind.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pre_tokens(text) -> Column:
    """Pre-tokens of a text; together they are the text.  White space is Unicode's."""
    return F.regexp_extract_all(text if isinstance(text, Column) else F.col(text), F.lit("(?U)" + PRE_TOKEN), F.lit(0))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of the pieces of ``word``: from single bytes on, the neighbours of lowest rank (of equal ones the first) are
    joined until no two neighbours are a token.  Long words go by a heap of neighbours, so the time is n log n."""
    import heapq
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))  # where the piece that starts here ends; 0 if none does any more
    heap = []

    def offer(a: int) -> None:
        b = right[a]
        if b < n:
            rank = ranks.get(word[a:end[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, end[b]))
    for a in range(n - 1):
        offer(a)
    while heap:
        _, a, stop = heapq.heappop(heap)
        b = right[a] if end[a] else n
        if not end[a] or b >= n or end[b] != stop or not end[b]:
            continue  # one of the two has been joined to another piece meanwhile
        end[a], right[a], end[b] = stop, right[b], 0
        if right[a] < n:
            left[right[a]] = a
        if left[a] >= 0:
            offer(left[a])
        offer(a)
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a:end[a]]])
        a = end[a]
    return out


def with_pieces(tokens: DataFrame, ranks_path: str, cfg: CorpusConfig) -> DataFrame:
    """``tokens`` (``token``, and columns that it was met with) with its ``ids``: ranks after the special ids.  The pieces
    of a token are found once."""
    ranks = read_ranks(ranks_path)
    first_id = max(cfg.pad_id, cfg.unk_id, cfg.bos_id, cfg.eos_id) + 1
    others = [c for c in tokens.columns if c != "token"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [[r + first_id for r in merged(t.as_py().encode(), ranks)] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], [*batch.schema.names, "ids"])

    found = tokens.groupBy("token").agg(F.collect_list(F.struct(*others)).alias("met")) if others else tokens.distinct()
    pieces = found.mapInArrow(run, StructType([*found.schema.fields, StructField("ids", ArrayType(IntegerType()))]))
    return pieces.select(F.explode("met").alias("met"), "token", "ids").select("met.*", "token", "ids") if others else pieces


def piece_table(texts: DataFrame, text_cols: list[str], ranks_path: str, cfg: CorpusConfig) -> DataFrame:
    """``token, ids`` of every distinct pre-token of the text columns."""
    found = texts.select(F.explode(F.array(*text_cols)).alias("text")).where(F.col("text").isNotNull())
    return with_pieces(found.select(F.explode(pre_tokens("text")).alias("token")), ranks_path, cfg)
