"""Training-set preparation.

Rows are encoded by the vocabulary's entries for the tokens of their cell: whitespace tokens of the corpus, numbered in Spark by
frequency, or the pieces that a published sub-word vocabulary gives each pre-token (``subword``).  Batching
cuts a drawn order of all rows, whose keys and lengths are dealt by ranges of the draw, pads to the batch
maximum and builds the label mask."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from threadsmith.config import IGNORE_LABEL, LENGTH_QUANTILES, CorpusConfig
from threadsmith.functions.draws import uniform
from threadsmith.functions.text import ascii_spaced, whitespace_tokens

#: cells of rows, each with its own dictionary, that the encoding makes of a shuffle partition
CELLS_A_PARTITION = 2


def format_rows(rows: DataFrame) -> DataFrame:
    """L1: ``Instruction: {i}\\n`` [+ ``Input: {x}\\n``] + ``Answer: ``; target = output."""
    inp = F.col("input")
    ctx = F.concat(F.lit("Instruction: "), F.col("instruction"), F.lit("\n"),
                   F.when(inp.isNotNull() & (F.length(inp) > 0), F.concat(F.lit("Input: "), inp, F.lit("\n")))
                   .otherwise(F.lit("")),
                   F.lit("Answer: "))
    return rows.withColumn("context", ctx).withColumn("target", F.col("output"))


def build_vocab(texts: DataFrame, text_cols: list[str], cfg: CorpusConfig) -> DataFrame:
    """``token, token_id, freq``: whitespace tokens numbered by falling frequency, then token, ids
    starting after the special ids; with ``vocab_size`` only the ids up to it.

    Tokens are numbered inside (frequency, first characters); the counts of these, and of the
    frequencies alone, give the offsets, so no task holds more than one of the three levels."""
    toks = None
    for c in text_cols:
        t = texts.select(F.explode(whitespace_tokens(F.col(c))).alias("token"))
        toks = t if toks is None else toks.unionByName(t)
    freq = toks.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).withColumn(
        "__p", F.coalesce(F.substring("token", 1, 3), F.lit("")))  # never null, so both uses of ``freq`` share its shuffle
    sizes = freq.groupBy("freq", "__p").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.unboundedPreceding
    by_freq = sizes.groupBy("freq").agg(F.sum("__n").alias("__n")).select("freq", F.coalesce(F.sum("__n").over(
        Window.orderBy(F.desc("freq")).rowsBetween(earlier, -1)), F.lit(0)).alias("__base"))
    by_prefix = sizes.select("freq", "__p", F.coalesce(F.sum("__n").over(
        Window.partitionBy("freq").orderBy("__p").rowsBetween(earlier, -1)), F.lit(0)).alias("__skip"))
    offsets = by_prefix.join(by_freq, "freq").select("freq", "__p", (F.col("__base") + F.col("__skip")).alias("__off"))
    place = F.row_number().over(Window.partitionBy("freq", "__p").orderBy("token"))
    first_id = max(cfg.pad_id, cfg.unk_id, cfg.bos_id, cfg.eos_id) + 1
    out = freq.withColumn("__rn", place).join(offsets, ["freq", "__p"]).select(
        "token", "freq", (F.col("__off") + F.col("__rn") + (first_id - 1)).cast("int").alias("token_id"))
    return out if cfg.vocab_size is None else out.filter(F.col("token_id") < first_id + cfg.vocab_size)


def first_tokens(text, cfg: CorpusConfig) -> Column:
    """A text up to the end of its first ``max_seq_length`` whitespace tokens, with ASCII spaces."""
    return F.regexp_extract(ascii_spaced(text), f"^\\s*+(?:\\S++\\s*+){{0,{cfg.max_seq_length}}}+", 0)


def cut_texts(rows: DataFrame, fields: list[str], cfg: CorpusConfig) -> DataFrame:
    """``rows`` with the ``first_tokens`` of each text field.  ``assemble`` takes no more of a field, so what it drops is
    neither shuffled nor numbered."""
    return rows.withColumns({f: first_tokens(f, cfg) for f in fields})


def cell_count(rows: DataFrame) -> int:
    return CELLS_A_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shared_cell(rows: DataFrame, alike: list[str], fields: list[str]) -> Column:
    """A cell for ``encode`` in which the rows of equal ``alike`` columns lie together, so that what their texts share is
    one token of the cell and, row by row, repeats in its shuffle.  Rows that miss one of these columns are dealt by their texts."""
    missing = reduce(or_, [F.col(c).isNull() for c in alike])
    draw = F.when(missing, F.xxhash64(*alike, *fields)).otherwise(F.xxhash64(*alike))
    return F.pmod(draw, F.lit(cell_count(rows))).cast("int")


def encode(rows: DataFrame, keys: list[str], fields: list[str], vocab: DataFrame | Callable[[DataFrame], DataFrame],
           cfg: CorpusConfig, tokens: Callable[[Column], Column] = whitespace_tokens, cell: Column | None = None,
           placed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``keys..., <field>_ids...``: token ids of each text field, unknown tokens -> ``unk_id``.  ``vocab`` gives a token's
    ``token_id`` or, for tokens of several pieces, its ``ids``; or it is a function that adds the ``ids`` to a table of
    ``cell, place, token``.  ``placed`` makes of the dealt rows (``__cell``, ``__row``, keys and fields) a table of one row for
    each, with ``__cell``, ``__row`` and further columns, which the encoded rows get; only these come back to the cells.

    Rows are dealt to cells by their hash, or by ``cell``.  Only the distinct tokens of a cell meet the vocabulary, by a join whose
    strategy is Spark's choice, as the vocabulary has no bound, and their ids come back by the token's place among the
    sorted tokens of the cell.  So the texts are shuffled once and no task holds more than one cell and its tokens."""
    if cell is None:
        cell = F.pmod(F.xxhash64(*keys, *fields), F.lit(cell_count(rows))).cast("int")
    none = F.array().cast("array<string>")
    columns = [f"{f}_ids" for f in fields]
    # all uses below read the same columns, so that Spark shuffles the texts once for them
    dealt = rows.select(*keys, *fields, cell.alias("__cell")).repartition("__cell")
    numbers, places, further = [], None, []
    if placed is not None:
        # rows that this order leaves equal are equal in all columns
        row = F.row_number().over(Window.partitionBy("__cell").orderBy(*keys, F.xxhash64(*fields)))
        numbers, rowed = ["__row"], dealt.withColumn("__row", row)
        places = placed(rowed)
        further = [f for f in places.schema.fields if f.name not in ("__cell", "__row")]

    def with_tokens(df: DataFrame, others: list[str]) -> DataFrame:
        return df.sortWithinPartitions("__cell").select(
            "__cell", *others, *[F.coalesce(tokens(F.col(f)), none).alias(c) for f, c in zip(fields, columns)])

    def distinct_tokens(table: pa.Table) -> pa.Table:
        found = _distinct(table, columns)
        cells = pa.repeat(table.column("__cell")[0], len(found))
        return pa.Table.from_arrays([cells, pa.array(np.arange(len(found), dtype=np.int32)), found], ["cell", "place", "token"])

    def numbered(table: pa.Table, entries: pa.Table) -> pa.Table:
        found = _distinct(table, columns)
        if packed:
            entry = entries.column("entry").to_numpy()
            entries = entries.append_column("place", pa.array(entry >> 32)).append_column("ids", pa.array(entry.astype(np.int32)))
        if further:
            own = pc.is_valid(entries.column("placed"))
            mine, entries = entries.filter(own), entries.filter(pc.invert(own))
            which = np.empty(len(mine), np.int64)
            which[mine.column("place").to_numpy() - 1] = np.arange(len(mine))
            mine = mine.column("placed").take(pa.array(which[table.column("__row").to_numpy() - 1]))
            for f in further:
                table = table.append_column(f.name, pc.struct_field(mine, [f.name]))
        known = entries.column("ids")
        ids = pa.concat_arrays([*known.chunks, pa.array([[cfg.unk_id] if pa.types.is_list(known.type) else cfg.unk_id], known.type)])
        which = np.full(len(found), len(known), np.int64)
        which[entries.column("place").to_numpy()] = np.arange(len(known))
        for c in columns:
            places = pc.index_in(_values(table, c), value_set=found).to_numpy()
            got = ids.take(pa.array(which[places]))
            stops = np.concatenate([[0], np.cumsum(pc.list_value_length(table.column(c)).to_numpy())])
            if pa.types.is_list(got.type):
                stops = np.concatenate([[0], np.cumsum(pc.list_value_length(got).to_numpy(zero_copy_only=False))])[stops]
                got = got.flatten()
            out = pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), got)
            table = table.set_column(table.schema.get_field_index(c), c, out)
        return table.select([*keys, *(f.name for f in further), *columns])

    met = with_tokens(dealt, keys).groupBy("__cell").applyInArrow(distinct_tokens, "cell int, place int, token string")
    # one number an id: the tokens of the cells and their ids are a large part of what is shuffled
    packed = not callable(vocab) and "ids" not in vocab.columns
    if packed:
        at = met.select("token", _pair(F.col("cell"), F.col("place")).alias("__at"))
        entries = at.join(vocab.select("token", "token_id"), "token").select(
            F.shiftright("__at", 32).cast("int").alias("cell"), _pair(F.col("__at"), F.col("token_id")).alias("entry"))
    else:
        entries = (vocab(met) if callable(vocab) else met.join(vocab.select("token", "ids"), "token")).select("cell", "place", "ids")
    kinds = {f.name: f for f in dealt.schema.fields}
    schema = StructType([*(kinds[k] for k in keys), *further, *(StructField(c, ArrayType(IntegerType())) for c in columns)])
    if further:
        both = StructType(further)
        own = [_pair(F.col("__row"), F.lit(0))] if packed else [F.col("__row"), F.lit(None).cast(entries.schema["ids"].dataType)]
        entries = entries.withColumn("placed", F.lit(None).cast(both)).union(
            places.select("__cell", *own, F.struct(*[f.name for f in further]).cast(both)))
    texts = with_tokens(rowed if numbers else dealt, [*keys, *numbers])
    return texts.groupBy("__cell").cogroup(entries.groupBy("cell")).applyInArrow(numbered, schema)


def _pair(high: Column, low: Column) -> Column:
    """The lower 32 bits of two numbers as one."""
    return F.shiftleft(high.cast("bigint"), 32).bitwiseOR(low.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))


def _values(table: pa.Table, column: str) -> pa.ChunkedArray:
    """The values of a column of lists, one after the other."""
    return pa.chunked_array([c.flatten() for c in table.column(column).chunks], pa.string())


def _distinct(table: pa.Table, columns: list[str]) -> pa.Array:
    """The distinct values of columns of lists, sorted."""
    found = pc.unique(pa.chunked_array([v for c in columns for v in _values(table, c).chunks], pa.string()))
    return found.take(pc.sort_indices(found))


def assemble(df: DataFrame, cfg: CorpusConfig, prompt_col: str = "context_ids",
             target_col: str = "target_ids") -> DataFrame:
    """L2/L3: prompt ids (truncated, then the begin-answer id), target ids (truncated),
    ``input_ids = (prompt + target + [eos])[:max]``, ``seq_len = len(prompt)``."""
    m = cfg.max_seq_length
    prompt = F.concat(F.slice(F.coalesce(F.col(prompt_col), F.array().cast("array<int>")), 1, m - 1),
                      F.array(F.lit(cfg.bos_id)))
    target = F.slice(F.coalesce(F.col(target_col), F.array().cast("array<int>")), 1, m)
    full = F.concat(prompt, target, F.array(F.lit(cfg.eos_id)))
    return (df.withColumn("__prompt", prompt)
            .withColumn("input_ids", F.slice(full, 1, m))
            .withColumn("seq_len", F.size("__prompt"))
            .drop("__prompt"))


def drop_overlength(df: DataFrame, max_len: int, ids_col: str = "input_ids") -> DataFrame:
    """L4 (dormant in the original): keep rows whose ids fit ``max_len``."""
    return df.filter(F.size(ids_col) <= max_len)


def sequence_length(context: Column, target: Column, cfg: CorpusConfig) -> Column:
    """Length of the assembled ``input_ids`` from the token counts alone: no vocabulary is needed."""
    m = cfg.max_seq_length
    prompt = F.least(F.size(whitespace_tokens(context)), F.lit(m - 1)) + 1
    return F.least(prompt + F.least(F.size(whitespace_tokens(target)), F.lit(m)) + 1, F.lit(m))


def length_quantiles(df: DataFrame, ids_col: str = "input_ids",
                     qs=LENGTH_QUANTILES) -> DataFrame:
    """Exact linearly-interpolated quantiles of the sequence length.  ``percentile``
    keeps a value->count map, bounded by the number of distinct lengths (<= max length)."""
    length = F.col(ids_col) if not dict(df.dtypes)[ids_col].startswith("array") else F.size(ids_col)
    agg = df.agg(F.percentile(length, F.array(*[F.lit(q) for q in qs])).alias("__v"))
    qarr = F.array(*[F.lit(q) for q in qs])
    return agg.select(F.explode(F.arrays_zip(qarr.alias("q"), F.col("__v").alias("v"))).alias("z")).select(
        F.col("z.q").alias("quantile"), F.col("z.v").alias("length"))


def batch_range(rows: DataFrame, keys: list[str], cfg: CorpusConfig) -> Column:
    """The range of a row in ``assign_batches``: all are equal parts of the drawn order."""
    return F.floor(uniform(keys, "order", cfg.seed) * cell_count(rows)).cast("int")


def assign_batches(rows: DataFrame, keys: list[str], cfg: CorpusConfig) -> DataFrame:
    """Rows in a drawn order, ``batch_size`` consecutive rows a batch: ``batch``, the batch's ``longest`` and
    ``pos_in_batch``, longest first.  ``rows`` have a ``length``, and ``__tie`` orders those of equal keys and lengths.

    Rows are dealt by their ``batch_range``, and no row leaves it then.  A range's first number is the count of the rows
    before it, and a batch that lies across ranges knows its other rows by their lengths: each range shows its neighbours
    less than a batch of rows at either end."""
    size = cfg.batch_size
    x = rows.withColumn("__u", uniform(keys, "order", cfg.seed)).withColumn("__range", batch_range(rows, keys, cfg))
    cell = Window.partitionBy("__range")
    # all columns take part, so that every use of this order numbers the rows alike and reads the same shuffle
    others = [c for c in rows.columns if c not in (*keys, "length", "__tie")]
    x = x.withColumn("__place", F.row_number().over(
        cell.orderBy("__u", *keys, F.desc("length"), "__tie", *others)).cast("bigint"))
    near_end = (F.col("__place") < size) | (F.col("__place") > F.col("__n") - size + 1)
    ends = x.withColumn("__n", F.count(F.lit(1)).over(cell)).where(near_end).groupBy(F.col("__range").alias("__c")).agg(
        F.first("__n").alias("__n"), F.collect_list(F.struct("__place", "length")).alias("__ends"))
    cells = Window.orderBy("__c")
    ends = ends.withColumn("__off", F.coalesce(F.sum("__n").over(cells.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ends = ends.withColumn("__ends", F.transform("__ends", lambda e: F.struct(
        (F.col("__off") + e["__place"] - 1).alias("rn"), e["length"].alias("length"))))
    # a range here has a row at least, so a batch reaches over less than ``size`` of them to either side
    beside = [F.flatten(F.collect_list("__ends").over(cells.rowsBetween(*r))) for r in ((1 - size, -1), (1, size - 1))]
    # a left join, as an inner one would add a filter below the shuffle of the rows, which were then shuffled anew
    x = x.join(ends.select("__c", "__off", F.concat(*beside).alias("__beside")), F.col("__range") == F.col("__c"), "left")
    x = x.withColumn("__rn", F.col("__off") + F.col("__place") - 1)
    x = x.withColumn("batch", F.floor(F.col("__rn") / size).cast("bigint"))
    x = x.withColumn("__others", F.filter("__beside", lambda e: F.floor(e["rn"] / size) == F.col("batch")))
    longest_first = Window.partitionBy("__range", "batch").orderBy(F.desc("length"), "__rn")
    before = F.filter("__others", lambda e: (e["length"] > F.col("length")) | (
        (e["length"] == F.col("length")) & (e["rn"] < F.col("__rn"))))
    x = x.withColumns({"__first": F.first("length").over(longest_first), "__in_cell": F.row_number().over(longest_first)})
    return x.select(*rows.columns, "batch",
                    F.greatest("__first", F.array_max(F.transform("__others", lambda e: e["length"]))).alias("longest"),
                    (F.col("__in_cell") + F.size(before)).cast("bigint").alias("pos_in_batch"))


def pad_and_mask(batched: DataFrame, cfg: CorpusConfig, ids_col: str = "input_ids") -> DataFrame:
    """Pad to the batch maximum, labels = ignore x (seq_len-1) + ids[seq_len-1:] + ignore x padding."""
    pad = F.col("longest") - F.col("length")
    x = batched.withColumn("padded_ids", F.concat(F.col(ids_col), F.array_repeat(F.lit(cfg.pad_id), pad)))
    labels = F.concat(F.array_repeat(F.lit(IGNORE_LABEL), F.col("seq_len") - 1),
                      F.slice(F.col(ids_col), F.col("seq_len"), F.col("length") - F.col("seq_len") + 1),
                      F.array_repeat(F.lit(IGNORE_LABEL), pad))
    return x.withColumn("labels", labels)


def chat_windows(pairs: DataFrame, cfg: CorpusConfig, conv_col: str = "conv_id", pair_col: str = "pair_no",
                 q_col: str = "question", a_col: str = "answer", delimiter: str = "||") -> DataFrame:
    """context = ``q||a||`` of up to ``chat_history_pairs - 1`` earlier pairs + the
    current question, with ``<br>`` removed.  The frame is bounded, so instead of a window
    over a whole conversation every pair is copied to itself and to the (at most 3) later
    pairs that see it, and grouped on ``(conv, pair)``: one shuffle, balanced even for a
    huge conversation, and no join back (the copy at lag 0 carries the pair itself; a
    group without it lies past the end of the conversation)."""
    h = max(cfg.chat_history_pairs - 1, 0)
    clean_q = F.replace(F.col(q_col), F.lit("<br>"), F.lit(""))
    lag = F.col("__lag")
    fwd = pairs.select(conv_col, pair_col, q_col, a_col, F.explode(F.sequence(F.lit(0), F.lit(h))).alias("__lag"))
    fwd = fwd.select(conv_col, (F.col(pair_col) + lag).alias(pair_col), lag,
                     F.when(lag == 0, F.col(q_col)).alias("__q"), F.when(lag == 0, F.col(a_col)).alias("__a"),
                     F.when(lag > 0, F.concat(clean_q, F.lit(delimiter), F.coalesce(F.col(a_col), F.lit("")),
                                              F.lit(delimiter))).alias("__piece"))
    g = fwd.groupBy(conv_col, pair_col).agg(
        F.count_if(lag == 0).alias("__self"),
        F.max("__q").alias(q_col), F.max("__a").alias(a_col),
        F.array_sort(F.collect_list(F.when(lag > 0, F.struct(F.negative(lag).alias("k"), F.col("__piece").alias("p")))))
        .alias("__hist"))
    prefix = F.array_join(F.transform(F.col("__hist"), lambda s: s["p"]), "")
    ctx = F.replace(F.concat(prefix, F.replace(F.col(q_col), F.lit("<br>"), F.lit(""))), F.lit("<br>"), F.lit(""))
    return g.filter(F.col("__self") > 0).select(conv_col, pair_col, q_col, a_col, ctx.alias("context"))


def left_trim_to_budget(text: Column, cfg: CorpusConfig) -> Column:
    """Drop ``chat_trim_step`` leading characters at a time until the whitespace token
    count is within ``chat_cutoff``.  A token survives a cut at offset c iff it ends after
    c, so with ``need = n_tokens - cutoff`` the smallest valid cut is the first multiple of
    the step at or after the end of token ``need``: one pass, no loop."""
    step, cut = cfg.chat_trim_step, cfg.chat_cutoff
    pieces = F.regexp_extract_all(ascii_spaced(text), F.lit("\\s*\\S+"), 0)
    need = F.size(pieces) - F.lit(cut)
    end_need = F.length(F.array_join(F.slice(pieces, F.lit(1), F.greatest(need, F.lit(1))), ""))
    start = (F.ceil(end_need / F.lit(step)) * step + 1).cast("int")
    return F.when(need > 0, F.substring(text, start, F.lit(2147483647))).otherwise(text)


def extract_answer(generated: Column) -> Column:
    """The text after the first ``Answer: `` marker (up to a second one)."""
    return F.get(F.split(generated, "Answer: "), 1)


def serving_prompt(context: Column) -> Column:
    """``Context: {c}Answer: ``."""
    return F.concat(F.lit("Context: "), context, F.lit("Answer: "))
