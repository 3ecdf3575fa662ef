"""Training-set queries over ``conversations`` and ``documents``.

Instruction rows = the whole corpus (originals, replies, reply topics); the vocabulary is built
from ``documents``; chat windows pair each user turn with the assistant turn after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsmith.config import ASCII
from threadsmith.functions.text import PY_SPACE_CLASS
from threadsmith.operators import subword, trainset
from threadsmith.operators.ordering import ordered_index
from threadsmith.plans import sqlfrag as S
from threadsmith.plans.corpus_plans import corpus_union, union_sql
from threadsmith.plans.registry import register, table

CFG = ASCII
KEYS = ["source", "id", "round"]
FIELDS = ["context", "target"]
TOK_RE = f"[^{PY_SPACE_CLASS}]+"


def formatted(spark: SparkSession, sf: str, cut=None) -> DataFrame:
    """The corpus as contexts and targets; with a configuration as ``cut``, no further than its sequences reach."""
    if cut is None:
        return trainset.format_rows(corpus_union(spark, sf)).select(*KEYS, *FIELDS)
    rows = corpus_union(spark, sf, lambda text: trainset.first_tokens(text, cut))
    return trainset.cut_texts(trainset.format_rows(rows).select(*KEYS, *FIELDS), FIELDS, cut)


def vocab(spark: SparkSession, sf: str) -> DataFrame:
    return trainset.build_vocab(table(spark, sf, "documents"), ["text"], CFG)


def encoded(spark: SparkSession, sf: str, cfg=CFG) -> DataFrame:
    rows = formatted(spark, sf, cfg)
    return trainset.assemble(trainset.encode(rows, KEYS, FIELDS, vocab(spark, sf), cfg, cell=text_cell(rows)), cfg)


def text_cell(rows: DataFrame):
    """The rounds of a post share a cell, as they share their text and its tokens."""
    return trainset.shared_cell(rows, ["source", "id"], FIELDS)


def batched(spark: SparkSession, sf: str) -> DataFrame:
    return batches_of(formatted(spark, sf, CFG), vocab(spark, sf), cut=True)


def batches_of(rows: DataFrame, entries: DataFrame, cfg=CFG, cut: bool = False) -> DataFrame:
    """Rows are batched by their keys and lengths alone, which are known without a vocabulary, and meet their place in a
    batch where they are encoded.  ``cut`` tells that ``rows`` are cut already."""
    rows = rows if cut else trainset.cut_texts(rows, FIELDS, cfg)
    length = trainset.sequence_length(*[F.coalesce(f, F.lit("")) for f in FIELDS], cfg)
    tie = F.xxhash64(*KEYS, *FIELDS, trainset.batch_range(rows, KEYS, cfg))

    def placed(dealt: DataFrame) -> DataFrame:
        lengths = dealt.select("__cell", "__row", *KEYS, length.cast("int").alias("length"), tie.alias("__tie"))
        return trainset.assign_batches(lengths, KEYS, cfg).drop(*KEYS, "__tie")
    enc = trainset.encode(rows, KEYS, FIELDS, entries, cfg, cell=text_cell(rows), placed=placed)
    return trainset.pad_and_mask(trainset.assemble(enc, cfg), cfg)


def chat_pairs(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    users = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    answers = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    pairs = users.join(answers, ["conv_id", "turn"], "left").withColumn("answer", F.coalesce("answer", F.lit("")))
    return ordered_index(pairs, ["conv_id"], ["turn"], idx_col="pair_no")


def chat(spark: SparkSession, sf: str) -> DataFrame:
    return trainset.chat_windows(chat_pairs(spark, sf), CFG)


# ---------------------------------------------------------------- SQL
ROWS_SQL = f"""{union_sql()},
frows AS (SELECT source, id, round, 'Instruction: ' || instruction || chr(10) ||
                 CASE WHEN length(input) > 0 THEN 'Input: ' || input || chr(10) ELSE '' END || 'Answer: ' AS context,
                 output AS target FROM u)"""
VOCAB_SQL = f"""vtok AS (SELECT unnest(regexp_extract_all(text, {S.q(TOK_RE)})) AS token FROM documents),
vfreq AS (SELECT token, count(*) AS freq FROM vtok GROUP BY token),
vocab AS (SELECT token, freq, CAST(row_number() OVER (ORDER BY freq DESC, token ASC) + 3 AS INTEGER) AS token_id
          FROM vfreq)"""
PROFILE = CFG.with_(max_seq_length=4096)


def enc_sql(M: int) -> str:
    return f"""{ROWS_SQL},
{VOCAB_SQL},
tk AS (SELECT source, id, round, f, unnest(generate_series(0, len(ts) - 1)) AS pos, unnest(ts) AS token
       FROM (SELECT source, id, round, 'context' AS f, regexp_extract_all(context, {S.q(TOK_RE)}) AS ts FROM frows
             UNION ALL
             SELECT source, id, round, 'target', regexp_extract_all(target, {S.q(TOK_RE)}) FROM frows)),
tid AS (SELECT source, id, round, f, list(coalesce(v.token_id, {CFG.unk_id}) ORDER BY pos) AS ids
        FROM tk LEFT JOIN vocab v USING (token) GROUP BY ALL),
asm AS (SELECT r.source, r.id, r.round,
               list_concat(coalesce(c.ids, []::INTEGER[])[1:{M - 1}], [{CFG.bos_id}]) AS p,
               coalesce(t.ids, []::INTEGER[])[1:{M}] AS t
        FROM frows r LEFT JOIN tid c ON c.source = r.source AND c.id = r.id AND c.round = r.round AND c.f = 'context'
                     LEFT JOIN tid t ON t.source = r.source AND t.id = r.id AND t.round = r.round AND t.f = 'target'),
enc AS (SELECT source, id, round, len(p) AS seq_len, list_concat(p, t, [{CFG.eos_id}])[1:{M}] AS input_ids FROM asm)"""


ENC_SQL = enc_sql(CFG.max_seq_length)
U_O = S.u(KEYS, "order")
BATCH_SQL = f"""{ENC_SQL},
bk AS (SELECT *, len(input_ids) AS length, {U_O} AS ord FROM enc),
rn AS (SELECT *, row_number() OVER (ORDER BY ord, source, id, round) AS rn FROM bk),
bt AS (SELECT *, CAST(floor((rn - 1) / {CFG.batch_size}) AS BIGINT) AS batch FROM rn),
pb AS (SELECT *, max(length) OVER (PARTITION BY batch) AS longest,
              CAST(row_number() OVER (PARTITION BY batch ORDER BY length DESC, rn) AS BIGINT) AS pos_in_batch
       FROM bt)"""
PAIRS_SQL = """pairs AS (SELECT u.conv_id, CAST(row_number() OVER (PARTITION BY u.conv_id ORDER BY u.turn) - 1 AS BIGINT)
                      AS pair_no, u.text AS q, coalesce(a.text, '') AS a
               FROM conversations u LEFT JOIN conversations a
                 ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
               WHERE u.role = 'user')"""
CHAT_SQL = f"""{PAIRS_SQL},
cw AS (SELECT conv_id, pair_no, q, a,
              replace(coalesce(array_to_string(list(replace(q, '<br>', '') || '||' || a || '||') OVER (
                  PARTITION BY conv_id ORDER BY pair_no ROWS BETWEEN {CFG.chat_history_pairs - 1} PRECEDING
                  AND 1 PRECEDING), ''), '') || replace(q, '<br>', ''), '<br>', '') AS context
       FROM pairs)"""
PIECE_RE = f"[{PY_SPACE_CLASS}]*[^{PY_SPACE_CLASS}]+"


@register("format_rows", oracle=f"{ROWS_SQL} SELECT * FROM frows")
def format_rows(spark: SparkSession, sf: str) -> DataFrame:
    return formatted(spark, sf)


@register("vocab", oracle=f"WITH {VOCAB_SQL} SELECT token, CAST(freq AS BIGINT) AS freq, token_id FROM vocab")
def vocab_q(spark: SparkSession, sf: str) -> DataFrame:
    return vocab(spark, sf).select("token", F.col("freq").cast("bigint"), "token_id")


@register("encode_rows", oracle=f"""{ENC_SQL}
SELECT source, id, round, CAST(seq_len AS BIGINT) AS seq_len, CAST(len(input_ids) AS BIGINT) AS n_ids,
       array_to_string(input_ids, ',') AS input_ids FROM enc""")
def encode_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = encoded(spark, sf)
    return e.select(*KEYS, F.col("seq_len").cast("bigint"), F.size("input_ids").cast("bigint").alias("n_ids"),
                    F.array_join("input_ids", ",").alias("input_ids"))


def subword_encoded(spark: SparkSession, sf: str, ranks_path: str) -> DataFrame:
    rows = formatted(spark, sf)
    pieces = lambda met: subword.with_pieces(met, ranks_path, CFG)
    return trainset.assemble(trainset.encode(rows, KEYS, FIELDS, pieces, CFG, subword.pre_tokens, text_cell(rows)), CFG)


@register("subword_rows")
def subword_rows(spark: SparkSession, sf: str) -> DataFrame:
    """L2/L3 with the pieces of a public byte-level vocabulary."""
    import public_tokenizers
    e = subword_encoded(spark, sf, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return e.select(*KEYS, F.col("seq_len").cast("bigint"), F.size("input_ids").cast("bigint").alias("n_ids"),
                    F.array_join("input_ids", ",").alias("input_ids"))


@register("length_quantiles", oracle=f"""{enc_sql(PROFILE.max_seq_length)}
SELECT unnest([0.9, 0.95, 0.97, 0.99, 0.999]::DOUBLE[]) AS quantile,
       unnest(quantile_cont(len(input_ids), [0.9, 0.95, 0.97, 0.99, 0.999]::DOUBLE[])) AS length FROM enc""")
def length_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Length profile at max length 4096 (as the original profiling script)."""
    rows = formatted(spark, sf)
    lengths = rows.select(trainset.sequence_length(F.col("context"), F.col("target"), PROFILE).alias("length"))
    q = trainset.length_quantiles(lengths, "length")
    return q.select(F.col("quantile").cast("double"), F.col("length").cast("double"))


@register("padded_batches", oracle=f"""{BATCH_SQL}
SELECT source, id, round, batch, pos_in_batch, CAST(length AS BIGINT) AS length, CAST(longest AS BIGINT) AS longest,
       array_to_string(list_concat(input_ids, list_transform(range(0, longest - length), lambda x: {CFG.pad_id})), ',')
         AS padded_ids
FROM pb""")
def padded_batches(spark: SparkSession, sf: str) -> DataFrame:
    b = batched(spark, sf)
    return b.select(*KEYS, "batch", "pos_in_batch", F.col("length").cast("bigint"),
                    F.col("longest").cast("bigint"), F.array_join("padded_ids", ",").alias("padded_ids"))


@register("label_mask", oracle=f"""{BATCH_SQL}
SELECT source, id, round, CAST(seq_len AS BIGINT) AS seq_len,
       array_to_string(list_concat(list_transform(range(0, seq_len - 1), lambda x: -100),
                                   input_ids[seq_len:length],
                                   list_transform(range(0, longest - length), lambda x: -100)), ',') AS labels
FROM pb""")
def label_mask(spark: SparkSession, sf: str) -> DataFrame:
    b = batched(spark, sf)
    return b.select(*KEYS, F.col("seq_len").cast("bigint"), F.array_join("labels", ",").alias("labels"))


@register("chat_window", oracle=f"WITH {CHAT_SQL} SELECT conv_id, pair_no, context FROM cw")
def chat_window(spark: SparkSession, sf: str) -> DataFrame:
    return chat(spark, sf).select("conv_id", "pair_no", "context")


@register("chat_left_trim", oracle=f"""WITH {CHAT_SQL},
tr AS (SELECT conv_id, pair_no, context, regexp_extract_all(context, {S.q(PIECE_RE)}) AS pieces FROM cw)
SELECT conv_id, pair_no,
       CASE WHEN len(pieces) - {CFG.chat_cutoff} > 0
            THEN substr(context, CAST(ceil(length(array_to_string(pieces[1:len(pieces) - {CFG.chat_cutoff}], ''))
                                           / {float(CFG.chat_trim_step)}) * {CFG.chat_trim_step} + 1 AS INTEGER))
            ELSE context END AS trimmed
FROM tr""")
def chat_left_trim(spark: SparkSession, sf: str) -> DataFrame:
    c = chat(spark, sf)
    return c.select("conv_id", "pair_no", trainset.left_trim_to_budget(F.col("context"), CFG).alias("trimmed"))


@register("answer_extract", oracle=f"""WITH {PAIRS_SQL}
SELECT conv_id, pair_no, 'Context: ' || q || 'Answer: ' AS prompt,
       string_split('Context: ' || q || 'Answer: ' || a, 'Answer: ')[2] AS answer
FROM pairs""")
def answer_extract(spark: SparkSession, sf: str) -> DataFrame:
    p = chat_pairs(spark, sf)
    prompt = trainset.serving_prompt(F.col("question"))
    return p.select("conv_id", "pair_no", prompt.alias("prompt"),
                    trainset.extract_answer(F.concat(prompt, F.col("answer"))).alias("answer"))
