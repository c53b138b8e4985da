"""Document chunking, request building and batch numbering.

A document is one row holding its token array (a token file is read whole,
so this is the granularity the data arrives in).  K9 runs *inside the row*
with higher-order functions: each cut depends on the previous one, so the
chunk bounds are folded with ``aggregate`` over at most ``ceil(n / max) + 1``
steps, and every step only inspects the 100-token look-ahead window via
``slice`` -- O(n / max * 100) per document, no explode, no shuffle, no Python.

Cut rule for a chunk starting at ``s`` with ``i0 = s + max_lines - 1``:
documents of at most ``max_lines`` tokens are one chunk; when ``i0`` reaches
the last token the rest is the last chunk; otherwise the chunk ends at the
first cut token (``. , ; ! ?``) in positions ``i0 .. i0 + 99`` (the 50-token
look-ahead slides 50 times), else at a hard cut ``i0 + 50``, else at the end.
The next chunk starts after the end (default) or, with ``compat_overlap``,
at ``max(i0, end - 49) + 1`` -- the original behaviour, which repeats the
look-ahead tokens at the start of the next chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera import fixed_values as fv
from tessera.functions import text as tx
from tessera.session import reusable

BOUNDS_TYPE = "array<struct<start:int,end:int>>"


def cut_flags(tokens: Column, token_text=lambda t: t["token"]) -> Column:
    """One character per token: ``1`` for a natural cut token, else ``0``.
    Computed once per document; the fold below only runs cheap ``instr`` /
    ``substring`` calls on it."""
    cut_set = F.array(*[F.lit(c) for c in fv.CUT_TOKENS])
    return F.concat_ws("", F.transform(
        tokens, lambda t: F.when(F.array_contains(cut_set, token_text(t)), F.lit("1")).otherwise(F.lit("0"))))


def chunk_bounds(
    flags: Column,
    max_lines: int,
    compat_overlap: bool = False,
    lookahead: int = fv.CHUNK_LOOKAHEAD,
) -> Column:
    """K9: ``array<struct<start, end>>`` (0-based, inclusive) of the chunks of
    one document, from its :func:`cut_flags` string."""
    if max_lines < 1:
        raise ValueError("max_lines must be >= 1")
    m, la = max_lines, lookahead
    n = F.length(flags)
    last = n - 1
    steps = F.sequence(F.lit(1), (F.floor(n / m) + 2).cast("int"))
    init = F.struct(F.lit(0).alias("s"), F.array().cast(BOUNDS_TYPE).alias("b"))

    def step(acc, _i):
        s = acc["s"]
        i0 = s + F.lit(m - 1)
        # first cut token in positions i0 .. i0 + 2*la - 1 (1-based hit, 0 = none)
        hit = F.instr(F.substring(flags, i0 + 1, 2 * la), F.lit("1"))
        end = (
            F.when(i0 >= last, last)
            .when(hit > 0, i0 + hit - 1)
            .when(i0 + F.lit(la) <= last, i0 + F.lit(la))
            .otherwise(last)
        )
        if compat_overlap:
            nxt = (F.when(i0 >= last, n)
                   .when(hit > 0, F.greatest(i0, i0 + hit - 1 - F.lit(la - 1)) + 1)
                   .otherwise(end + 1))
        else:
            nxt = end + 1
        add = F.array(F.struct(s.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.when(s >= n, acc).otherwise(
            F.struct(nxt.cast("int").alias("s"), F.concat(acc["b"], add).alias("b")))

    folded = F.aggregate(steps, init, step)["b"]
    single = F.array(F.struct(F.lit(0).alias("start"), (n - 1).cast("int").alias("end")))
    return F.when(n <= m, single).otherwise(folded)


def split_documents(
    docs: DataFrame,
    file_col: str,
    tokens_col: str,
    max_lines: int,
    compat_overlap: bool = False,
) -> DataFrame:
    """K9 + G5: one row per chunk
    ``(source_file, chunk_index, total_chunks, start, end, tokens)``."""
    f = docs.select(
        F.col(file_col).alias("source_file"), F.col(tokens_col).alias("_toks"),
        cut_flags(F.col(tokens_col)).alias("_flags"),
    )
    b = f.select("source_file", "_toks", chunk_bounds(F.col("_flags"), max_lines, compat_overlap).alias("_b"))
    # ``posexplode_outer``: the bounds array is never empty, and the outer form
    # keeps the optimizer from inferring a ``size(_b) > 0`` filter that would be
    # pushed below the projection and re-evaluate the whole fold from the text.
    return b.select(
        "source_file",
        F.size("_b").alias("total_chunks"),
        F.posexplode_outer("_b").alias("chunk_index", "_bd"),
        "_toks",
    ).select(
        "source_file", "chunk_index", "total_chunks",
        F.col("_bd.start").alias("start"), F.col("_bd.end").alias("end"),
        F.slice("_toks", F.col("_bd.start") + 1, F.col("_bd.end") - F.col("_bd.start") + 1).alias("tokens"),
    )


def text_tokens(text: Column, label: Column | None = None) -> Column:
    """Words and single punctuation marks of a text as ``array<struct<token,label>>``
    (label ``B-CAP`` for capitalised words, else ``O``, unless given)."""
    toks = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"), 0)
    return F.transform(toks, lambda t: F.struct(
        t.alias("token"),
        (label if label is not None else F.when(t.rlike(r"^\p{Lu}"), F.lit("B-CAP")).otherwise(F.lit("O"))).alias("label"),
    ))


# ---------------------------------------------------------------- B12
def chunk_custom_id(file: Column, index: Column) -> Column:
    """``<file>__chunk_<i>``."""
    return F.concat(file.cast("string"), F.lit(fv.CHUNK_ID_SEPARATOR), index.cast("string"))


def custom_id_file(custom_id: Column) -> Column:
    """B12 inverse: the file part (everything before the last ``__chunk_<n>``)."""
    return F.regexp_extract(custom_id, r"^(.*)__chunk_(\d+)$", 1)


def custom_id_index(custom_id: Column) -> Column:
    return F.regexp_extract(custom_id, r"^(.*)__chunk_(\d+)$", 2).try_cast("int")


# ---------------------------------------------------------------- B13, B11
DEFAULT_SYSTEM_PROMPT = "You translate annotated biomedical tokens into Spanish."
DEFAULT_PROMPT_TEMPLATE = (
    "Translate the tokens below into Spanish. Keep every label exactly as given; "
    "B- starts an entity, I- continues it, O is outside any entity.\n\n"
    "INPUT:\n%s%s\n\nOUTPUT:"
)
DEFAULT_PART_NOTE = "\nNOTE: this is fragment %d of %d of the document."


def build_prompt(tokens: Column, chunk_index: Column, total_chunks: Column,
                 template: str = DEFAULT_PROMPT_TEMPLATE, part_note: str = DEFAULT_PART_NOTE) -> Column:
    """Prompt text = template filled with the chunk's ``token<TAB>label``
    lines and, for multi-chunk documents, a fragment note (1-based)."""
    note = F.when(total_chunks > 1, F.format_string(part_note, chunk_index + 1, total_chunks)).otherwise(F.lit(""))
    return F.format_string(template, tx.tokens_to_text(tokens), note)


def request_struct(custom_id: Column, prompt: Column, model: str, temperature: float, max_tokens: int,
                   system_prompt: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """The batch request record."""
    return F.struct(
        custom_id.alias("custom_id"),
        F.lit(fv.REQUEST_METHOD).alias("method"),
        F.lit(fv.REQUEST_URL).alias("url"),
        F.struct(
            F.lit(model).alias("model"),
            F.array(
                F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")),
                F.struct(F.lit("user").alias("role"), prompt.alias("content")),
            ).alias("messages"),
            F.lit(float(temperature)).alias("temperature"),
            F.lit(int(max_tokens)).alias("max_tokens"),
        ).alias("body"),
    )


def build_requests(chunks: DataFrame, model: str, temperature: float = 0.1, max_tokens: int = 4000,
                   template: str = DEFAULT_PROMPT_TEMPLATE) -> DataFrame:
    """B11 + B12 + B13 over chunk rows: ``(source_file, chunk_index, request)``."""
    cid = chunk_custom_id(F.col("source_file"), F.col("chunk_index"))
    prompt = build_prompt(F.col("tokens"), F.col("chunk_index"), F.col("total_chunks"), template)
    return chunks.select("source_file", "chunk_index", "total_chunks",
                         request_struct(cid, prompt, model, temperature, max_tokens).alias("request"))


# ---------------------------------------------------------------- G6
def dense_index(df: DataFrame, order_cols: list[str], out: str = "idx") -> DataFrame:
    """0-based dense index in ``order_cols`` order, without a single-partition
    window and without moving rows through Python:

    1. the rows are range-sorted and written to the checkpoint folder, so both
       passes below see the same partitions;
    2. the rows of each sorted partition are counted (one row per partition)
       and turned into start offsets -- a window over that tiny table;
    3. index = partition offset + position inside the partition.

    Every row keeps its place: null keys sort first, and rows of equal keys
    get successive numbers in no particular order."""
    rows = reusable(df.orderBy(*order_cols).withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    counts = rows.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition of the sort: a bounded broadcast
    return rows.join(F.broadcast(offsets), "_pid").withColumn(
        out, F.col("_off") + F.col("_mid") - F.col("_first")).drop("_pid", "_mid", "_first", "_off")


def assign_batches(df: DataFrame, order_cols: list[str], batch_size: int) -> DataFrame:
    """``batch_no = idx // batch_size`` in a deterministic order."""
    return dense_index(df, order_cols, "_idx").withColumn(
        "batch_no", (F.col("_idx") / batch_size).cast("int")).drop("_idx")


def batch_info(batched: DataFrame) -> DataFrame:
    """Chunks per batch and the distinct source files of each batch
    (at most ``batch_size`` per batch, so the set is bounded)."""
    return batched.groupBy("batch_no").agg(
        F.count("*").alias("chunks"),
        F.sort_array(F.collect_set("source_file")).alias("files"),
    )
