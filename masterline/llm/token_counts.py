"""Token counts by distinct pre-token, for a sentencepiece BPE model."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import stage, text_of

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Pre-tokens with at least 1/HEAD of all occurrences are broadcast: at most HEAD of them, of at most
#: HEAD_CHARS characters. All others are joined by shuffling.
HEAD = 2_000_000
HEAD_CHARS = 64
#: Distinct pre-tokens that a task holds before it hands them on.
FLUSH = 400_000

#: Pre-tokens are a run of spaces (written U+2581 by the model) and the run of other characters after it,
#: or such a run at the start of a line. No piece of the model has anything before a space or holds a line
#: feed with more, so merges never cross these borders. A leading LF marks a pre-token without a space.
MARK = "▁"


def pretokens(text: str) -> tuple[list[str], int]:
    """Pre-tokens of a text, and the number of line feeds between them."""
    if not text:
        return [], 0
    lines = (" " + text.replace(MARK, " ")).split("\n")
    out: list[str] = []
    for i, line in enumerate(lines):
        if not line:
            continue
        parts = line.split(" ")
        if "  " in line or line[-1] == " ":
            parts = spaced(parts)
        head = parts[0]
        if head:
            out.append(("\n" + head) if i or head else head)
        out += parts[1:]
    return out, len(lines) - 1


def spaced(parts: list[str]) -> list[str]:
    """Parts between single spaces, with the empty ones between given as spaces to the part after them."""
    out, extra = [parts[0]], 0
    for part in parts[1:]:
        if part:
            out.append(" " * extra + part)
            extra = 0
        else:
            extra += 1
    if extra:
        out.append(" " * (extra - 1))
    return out


def counter(model: bytes):
    """pre-token -> number of pieces, by the model itself."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    frame = len(sp.encode("\n"))

    def count(words: list[str]) -> list[int]:
        whole = [w[1:] if w[:1] == "\n" else " " + w for w in words]
        return [len(x) - frame for x in sp.encode(["\n" + w for w in whole], num_threads=1)]

    return count, frame - 1


def check_model(model: bytes) -> None:
    """Refuse a model whose pieces cross the borders of pre-tokens."""
    import re

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    across = re.compile(f"[^{MARK}]{MARK}|.\n|\n.", re.S)
    if any(across.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size())) or len(sp.encode("a")) != 1 or sp.encode(" \n", out_type=str)[-1] not in ("<0x0A>", "\n"):
        raise ValueError("the model merges across spaces or line feeds")


def count_tokens(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every document, as the whole text's encoding would have.

    One pass gathers the distinct pre-tokens of the corpus with their frequency; each is encoded once, for
    its number of pieces only. A second pass gives every document's frequencies: those of the most frequent
    pre-tokens (a bounded number, see HEAD) meet a broadcast table, all others are shuffled to the full
    table and summed per document. Null and empty texts have no tokens; repeated rows are counted each; a null id
    stays; a very long word is a pre-token like any other, and is never broadcast; an empty table gives none.
    """
    import public_tokenizers

    spark = docs.sparkSession
    data = Path(model or public_tokenizers.path(MODEL)).read_bytes()
    check_model(data)
    proto = spark.sparkContext.broadcast(data)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(pretokens(text.as_py())[0])
                if len(seen) > FLUSH:
                    yield table(seen)
                    seen = Counter()
        yield table(seen)

    def table(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, _ = counter(proto.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(count(batch.column(0).to_pylist()), pa.int32())], names=["word", "n", "pieces"])

    words = rows.select("text").mapInArrow(gather, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    known = stage(words.mapInArrow(pieces, "word string, n long, pieces int"), "pieces-by-word")
    total = known.agg(F.sum("n")).first()[0] or 0
    frequent = known.filter((F.col("n") * head >= total) & (F.length("word") <= HEAD_CHARS)).select("word", "pieces")
    lookup = spark.sparkContext.broadcast({r[0]: r[1] for r in frequent.toLocalIterator()})

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookup.value
        _, feed = counter(proto.value)
        for batch in batches:
            sums, rest = [], []
            for text in batch.column(2):
                parts, feeds = pretokens(text.as_py())
                got = [table.get(w, -1) for w in parts]
                other = Counter(w for w, n in zip(parts, got, strict=True) if n < 0)
                sums.append(sum(got) + other.total() + feeds * feed)
                rest.append(list(other.items()))
            kind = pa.map_(pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(sums, pa.int64()), pa.array(rest, kind)], names=["row", "doc_id", "n_bytes", "known", "rest"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = stage(
        rows.select("row", "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes")).mapInArrow(measure, f"row long, doc_id {kind}, n_bytes long, known long, rest map<string,int>"),
        "token-rows",
    )
    rest = measured.select("row", F.explode("rest").alias("word", "times"))
    added = rest.join(known.select("word", "pieces"), "word").groupBy("row").agg(F.sum(F.col("times").cast("long") * F.col("pieces")).alias("added"))
    return measured.select("row", "doc_id", "n_bytes", "known").join(added, "row", "left").select("doc_id", "n_bytes", (F.col("known") + F.coalesce("added", F.lit(0))).alias("n_tokens"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its bytes and tokens: see count_tokens for edge cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)
