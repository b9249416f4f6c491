"""Token counts of whole texts from counts of their pre-tokens.

The vocabulary has no piece that goes on with a space after another character, none that holds a line
end, and none with a letter next to anything but letters and a space before them. So no merge crosses
such places, and a text's count is the sum over its pre-tokens: runs of letters, or of other signs,
with the spaces before them (the library puts one before the text), and line ends.

Texts are cut block by block. A block keeps its different pre-tokens once, and per document which of
them it has and how often. Pre-tokens of all blocks meet by hash, the different ones are counted once
each, and their counts go back to the blocks that have them, to be joined to the documents'
frequencies. No ids of a text are ever made.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumeline.llm.common import STEP_BYTES, run_sums, steps, written

MODEL = "piece_bpe_32k.model"
#: The model's sign for a space.
SPACE = "▁"
#: Letters that are cut off from other signs, as a class of a regular expression.
LETTERS = "A-Za-zÀ-ɏ"
#: Shares of all pre-tokens, by hash; a task remembers the different pre-tokens of one share at a time.
SHARES = 4096


def counter(name: str):
    """The worker's own processor of a model file, made and checked at first use."""
    made = sys.modules.setdefault("_plumeline_counters", types.ModuleType("_plumeline_counters")).__dict__
    if name not in made:
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
        plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        across = re.compile(f"[^{SPACE}]{SPACE}|\n|[{LETTERS}][^{LETTERS}]|[^{LETTERS}{SPACE}][{LETTERS}]")
        if any(across.search(model.id_to_piece(i)) for i in plain):
            raise ValueError(f"{name} has pieces across the cuts at spaces, line ends or letters")
        if model.encode("a  b ", out_type=str) != [f"{SPACE}a", SPACE, f"{SPACE}b", SPACE]:
            raise ValueError(f"{name} does not keep spaces as they are")
        if len(model.encode("\n\n")) != len(model.encode("\n")) + 1:
            raise ValueError(f"{name} has no piece for a line end")
        made[name] = model
    return made[name]


def piece_counts(tokens: list[str], name: str = MODEL) -> list[int]:
    """Pieces of each pre-token; a line end before it keeps the library's own space away from it."""
    model = counter(name)
    lead = len(model.encode("\n"))
    return [len(ids) - lead for ids in model.encode(["\n" + t for t in tokens], num_threads=1)]


def pre_tokens(text: pa.Array) -> pa.ListArray:
    """Each text's pre-tokens, spaces as the model's sign. They are cut at line ends, so some are empty, but hold none."""
    text = pc.fill_null(text, "")
    signs = pc.replace_substring(text, " ", SPACE)
    framed = pc.binary_join_element_wise(pc.if_else(pc.equal(text, ""), "", SPACE), signs, "")
    cuts = ((f"([^{SPACE}\n])({SPACE})"), f"([{LETTERS}])([^{LETTERS}{SPACE}\n])", f"([^{LETTERS}{SPACE}\n])([{LETTERS}])")
    for cut in cuts:
        framed = pc.replace_substring_regex(framed, cut, r"\1" + "\n" + r"\2")
    return pc.split_pattern(framed, "\n")


def frequencies(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, codes, times) of each run's different codes."""
    width = int(codes.max()) + 1 if len(codes) else 1
    run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    cell, times = np.unique(run * width + codes, return_counts=True)
    return np.searchsorted(cell, np.arange(len(starts)) * width), cell % width, times


def packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of small numbers as binary: one byte that says how many bytes each takes, and the numbers."""
    out = []
    for a, b in zip(starts.tolist(), starts[1:].tolist()):
        own = values[a:b]
        kind = np.uint8 if not len(own) or own.max() < 1 << 8 else np.uint16 if own.max() < 1 << 16 else np.uint32
        # Byte by byte of all numbers: the high bytes are mostly zero and compress away.
        out.append(bytes((kind().itemsize,)) + own.astype(kind).view(np.uint8).reshape(-1, kind().itemsize).T.tobytes())
    return pa.array(out, pa.binary())


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts, values) of what ``packed`` made."""
    runs = [np.ascontiguousarray(np.frombuffer(x, np.uint8, offset=1).reshape(x[0], -1).T).view(f"<u{x[0]}").ravel().astype(np.int64) for x in column.to_pylist()]
    starts = np.cumsum([0] + [len(r) for r in runs])
    return starts, np.concatenate(runs) if runs else np.zeros(0, np.int64)


def _shares(words: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """A block's pre-tokens by share: (share, pre-tokens joined by line ends, codes)."""
    share = np.fromiter((zlib.crc32(w) % SHARES for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words))
    order = np.argsort(share, kind="stable")
    first = np.flatnonzero(np.diff(share[order], prepend=-1))
    starts = np.append(first, len(order))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words.take(pa.array(order))), "\n")
    return share[order][first], joined, packed(gaps_of(order, starts), starts)


def gaps_of(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ascending runs as steps, which are small; each run's first number is kept."""
    gaps = np.diff(codes, prepend=0)
    first = starts[:-1][np.diff(starts) > 0]
    gaps[first] = codes[first]
    return gaps


def from_gaps(gaps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(gaps)])
    return total[1:] - np.repeat(total[starts[:-1]], np.diff(starts))


def _blocks(schema: pa.Schema, bytes_: int):
    """Rows of documents and of pre-tokens; a block is what one step of text holds."""

    def batch_of(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in steps(batch, "text", bytes_):
                n, text = part.num_rows, part.column(1)
                tokens = pre_tokens(text)
                coded = tokens.flatten().dictionary_encode()
                offsets = tokens.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
                starts, codes, times = frequencies(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets)
                size, lines = (pc.cast(pc.fill_null(c, 0), pa.int64()) for c in (pc.binary_length(text), pc.count_substring(text, "\n")))
                freq = {"gaps": packed(gaps_of(codes, starts), starts), "times": packed(times, starts)}
                yield batch_of(n, key=part.column(0), n_bytes=size, lines=lines, block=pa.array([block] * n, pa.int64()), **freq)
                share, words, own = _shares(coded.dictionary)
                m = len(share)
                yield batch_of(m, block=pa.array([block] * m, pa.int64()), share=pa.array(share), words=words, gaps=own)
                block += 1

    return run


def _counted(name: str):
    """(block, gaps, pieces) from (share, block, gaps, words) in order of shares; each different pre-token is counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, known = None, {}
        for batch in batches:
            lists = [w.split("\n") for w in batch.column(3).to_pylist()]
            found = []
            for own, words in zip(batch.column(0).to_pylist(), lists):
                if own != share:
                    share, known = own, {}
                new = [w for w in words if w not in known]
                known.update(zip(new, piece_counts(new, name)))
                found += [known[w] for w in words]
            starts = np.cumsum([0] + [len(x) for x in lists])
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), packed(np.array(found, np.int64), starts)], ["block", "gaps", "pieces"])

    return run


def _added(own: pa.Table, known: pa.Table) -> pa.Table:
    """Tokens of a block's documents: frequencies times the counts of the block's pre-tokens."""
    listed = [unpacked(known.column(c).combine_chunks()) for c in ("gaps", "pieces")]
    table = np.zeros(len(listed[0][1]), np.int64)
    table[from_gaps(listed[0][1], listed[0][0])] = listed[1][1]
    starts, gaps = unpacked(own.column("gaps").combine_chunks())
    _, times = unpacked(own.column("times").combine_chunks())
    tokens = run_sums(table[from_gaps(gaps, starts)] * times, starts).astype(np.int64) + own.column("lines").to_numpy()
    return own.select(["key", "n_bytes"]).append_column("n_tokens", pa.array(tokens, pa.int64()))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 4096, name: str = MODEL, bytes_: int = STEP_BYTES) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row: UTF-8 bytes, tokens, and whether those are over ``limit``.

    Tokens are those the library gives for the whole text, without begin or end: strings like ``<s>``
    are ordinary text. A null or empty text has none. Keys may be null or repeated and are only handed
    on; other columns are ignored; an empty table gives no rows. A very long text is a block of its own.
    """
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    parts = {"n_bytes": T.LongType(), "lines": T.LongType(), "block": T.LongType(), "gaps": T.BinaryType(), "times": T.BinaryType(), "share": T.LongType(), "words": T.StringType()}
    kinds = T.StructType([T.StructField("key", source.schema["key"].dataType), *[T.StructField(c, t) for c, t in parts.items()]])
    rows = written(source.mapInArrow(_blocks(to_arrow_schema(kinds), bytes_), kinds), "blocks")
    shares = rows.where("share is not null").select("share", "block", "gaps", "words")
    pieces = shares.repartition("share").sortWithinPartitions("share").mapInArrow(_counted(name), "block long, gaps binary, pieces binary")
    documents = rows.where("share is null").select(F.col("block").alias("of"), "key", "n_bytes", "lines", "gaps", "times")
    out = T.StructType([kinds["key"], kinds["n_bytes"], T.StructField("n_tokens", T.LongType())])
    found = documents.groupBy("of").cogroup(pieces.groupBy("block")).applyInArrow(_added, out)
    return found.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
