"""BPE with word ends over whole texts, by tree concatenation (operator 9).

This kind of tokenizer drops white space, so the stretches between white space
are encoded by themselves.  Within a stretch, the tokenizer's own pattern gives words.
Words repeat: a task keeps a memo of stretches, emptied when full.

A word above a small length is encoded as a tree: its halves by themselves, down to leaves of some bytes, and then joined
pair by pair, level by level.  Within a task that is a recursion.  A stretch of very long text that nothing splits has its words cut
into larger leaves, which different tasks encode and join, one Spark job a level.  At a join, a window of tokens on either side is encoded
anew; it grows until its first token is the left side's and its last token is the right side's.
A token sequence is the BPE of its bytes exactly when each pair of neighbours is, so agreement at both ends
proves the joined sequence, and each join costs a window, not the text.

The merge loop is that of the tiktoken library over a rank table built from the tokenizer's own
file.  The end of a word is written as one byte that UTF-8 never uses.

Null texts are empty and have no ids.  Repeated rows and null ids give rows of their own.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from viewpulse.llm.byte_bpe import _byte_of_char
from viewpulse.llm.common import cut, text_or_empty

WHITE = re.compile(r"[ \t\n\x0b\x0c\r]+")
#: White space that str.split() knows besides the above; tokenizers may see some of it as text.
OTHER_WHITE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Characters whose case, composition and class are the same in all versions of Unicode that libraries follow.
PLAIN = re.compile("[\x00-\x7f\xa1-ɏ]*")
WORD_END = b"\xff"


def stretches(text: str) -> list[str]:
    if OTHER_WHITE.search(text):
        return [s for s in WHITE.split(text) if s]
    return text.split()


class WordBpe:
    def __init__(self, path: str, memo_size: int = 150_000):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path) as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        end = spec["model"]["end_of_word_suffix"]
        byte = self.byte = _byte_of_char()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            own = token.removesuffix(end)
            ranks[bytes(byte[c] for c in own) + (WORD_END if own != token else b"")] = i
        # a word's end is merged before all else, and needs no token of its own
        ranks.pop(WORD_END, None)
        self.offset = 1
        self.ranks = tiktoken.Encoding("words", pat_str=r"\S+", special_tokens={},
                                       mergeable_ranks={b: i + self.offset for b, i in ranks.items()} | {WORD_END: 0})
        self.token_bytes = {i + self.offset: b for b, i in ranks.items()} | {0: WORD_END}
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        self.names = [(self.library.id_to_token(i) or "").encode() for i in range(size)]
        self.memo: dict[str, bytes] = {}
        self.memo_size = memo_size

    # one word or part of a word, as numbers of the rank table
    def merge(self, part: bytes) -> list[int]:
        return self.ranks._encode_single_piece(part)

    def tree(self, part: bytes, leaf: int = 24) -> np.ndarray:
        """The merge of a word or part of one, by halves where it is longer than a leaf."""
        if len(part) <= leaf:
            return np.array(self.merge(part), np.int64)
        half = len(part) // 2
        return self.join(self.tree(part[:half], leaf), self.tree(part[half:], leaf))

    def units(self, stretch: str) -> list[int | str]:
        """A stretch split at special tokens: their ids, and the text between them."""
        if not (self.split_special and self.split_special.search(stretch)):
            return [stretch]
        out, at = [], 0
        for m in self.split_special.finditer(stretch):
            out += [stretch[at : m.start()], self.special[m.group()]]
            at = m.end()
        return [u for u in [*out, stretch[at:]] if u != ""]

    def word_bytes(self, stretch: str) -> list[bytes]:
        """The words of a stretch without special tokens, normalised, each with its end.

        Where a version of Unicode might matter, the library's own normaliser and splitter say what they are.
        """
        if not PLAIN.fullmatch(stretch):
            words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(stretch))
            return [bytes(self.byte[c] for c in w) + WORD_END for w, _ in words]
        low = unicodedata.normalize("NFC", stretch).replace("Σ", "σ").lower()
        return [w.encode() + WORD_END for w in self.words.findall(low)]

    def join(self, left: np.ndarray, right: np.ndarray, window: int = 4) -> np.ndarray:
        """The merge of the concatenated bytes of two merged parts."""
        while True:
            a, b = left[-window:], right[:window]
            again = self.merge(b"".join(self.token_bytes[i] for i in [*a.tolist(), *b.tolist()]))
            if (window >= len(left) or again[0] == a[0]) and (window >= len(right) or again[-1] == b[-1]):
                return np.concatenate([left[: max(0, len(left) - window)], np.array(again, np.int64), right[window:]])
            window *= 2

    def _encode_stretch(self, stretch: str) -> bytes:
        out = array("I")
        for unit in self.units(stretch):
            if isinstance(unit, int):
                out.append(unit)
            else:
                for w in self.word_bytes(unit):
                    out.extend([i - self.offset for i in (self.merge(w) if len(w) <= 24 else self.tree(w).tolist())])
        return out.tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        memo, parts = self.memo, stretches(text)
        out = [*map(memo.get, parts)]
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    ids = memo.get(parts[i])
                    if ids is None:
                        ids = self._encode_stretch(parts[i])
                        if len(parts[i]) <= 64:
                            if len(memo) >= self.memo_size:
                                memo.clear()
                            memo[parts[i]] = ids
                    out[i] = ids
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """Without a decoder of its own, such a tokenizer joins the tokens by spaces."""
        names = self.names
        return b" ".join([names[i] for i in memoryview(ids).cast("I") if names[i]])


def _schema(docs: DataFrame, id_col: str, *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("id", docs.schema[id_col].dataType), *more])


IDS = T.StructField("ids", T.BinaryType())
DECODED = T.StructField("decoded", T.StringType())


def _slices(batch: pa.RecordBatch, rows: int = 500):
    """A batch in small parts, as ids and texts take several times the room of their input."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _encode_whole(docs: DataFrame, path: str, decoded: bool) -> DataFrame:
    def run(batches):
        bpe = WordBpe(path)
        for batch in batches:
            for b in _slices(batch):
                ids = [bpe.encode(t) for t in b.column(1).to_pylist()]
                columns = {"id": b.column(0), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array([bpe.decode(x).decode("utf-8", "replace") for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, _schema(docs, "id", IDS, *([DECODED] if decoded else [])))


def _long_parts(docs: DataFrame, path: str, leaf_bytes: int) -> DataFrame:
    """``row, id, seg, leaf, leaves, part, ids``: a text in order of segments; a segment is either encoded or a leaf of a long word."""
    def run(batches):
        bpe = WordBpe(path)
        for b in batches:
            for i, (row, text) in enumerate(zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)):
                rows, ready = [], []

                def close(rows=rows, ready=ready):
                    if ready:
                        rows.append((len({r[0] for r in rows}), 0, 1, None, b"".join(ready)))
                        ready.clear()

                for s in stretches(text):
                    if len(s) * 4 <= leaf_bytes:
                        ready.append(bpe.encode(s))
                        continue
                    for unit in bpe.units(s):
                        if isinstance(unit, int):
                            ready.append(int(unit).to_bytes(4, "little"))
                            continue
                        for w in bpe.word_bytes(unit):
                            if len(w) <= leaf_bytes:
                                ready.append(array("I", [x - bpe.offset for x in bpe.tree(w).tolist()]).tobytes())
                                continue
                            close()
                            seg, n = len({r[0] for r in rows}), -(-len(w) // leaf_bytes)
                            rows += [(seg, k, n, w[k * leaf_bytes : (k + 1) * leaf_bytes], None) for k in range(n)]
                close()
                rows = rows or [(0, 0, 1, None, b"")]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([i] * len(rows))), pa.array([row] * len(rows), pa.int64()),
                     *[pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))]],
                    names=["id", "row", "seg", "leaf", "leaves", "part", "ids"])

    fields = [T.StructField("row", T.LongType()), T.StructField("seg", T.IntegerType()), T.StructField("leaf", T.IntegerType()),
              T.StructField("leaves", T.IntegerType()), T.StructField("part", T.BinaryType()), IDS]
    return docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, _schema(docs, "id", *fields))


def _merge_leaves(parts: DataFrame, path: str) -> DataFrame:
    """``row, seg, ids`` of all long words: leaves in parallel, then joins up the tree."""
    names, fields = ["row", "seg", "leaf", "merged"], "row long, seg int, leaf int, merged binary"

    def leaves(batches):
        bpe = WordBpe(path)
        for b in batches:
            merged = [bpe.tree(p).tobytes() for p in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(3)], pa.array(merged, pa.binary())], names=names)

    def joins(batches):
        """Neighbours come one after the other, so a task joins many pairs with one tokenizer."""
        bpe, before = WordBpe(path), None
        for b in batches:
            done = []
            for row, seg, leaf, merged in zip(*[c.to_pylist() for c in b.columns]):
                if leaf % 2 and before:
                    both = bpe.join(np.frombuffer(before[3], np.int64), np.frombuffer(merged, np.int64))
                    done.append((row, seg, leaf // 2, both.tobytes()))
                    before = None
                else:
                    done += [before] if before else []
                    before = (row, seg, leaf // 2, merged)
            yield batch_of(done)
        if before:
            yield batch_of([before])

    def batch_of(rows):
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    most = parts.agg(F.max("leaves")).first()[0] or 1
    now = parts.where("part is not null").select("row", "seg", "leaf", "part").repartition("row", "seg", "leaf")
    now = cut(now.mapInArrow(leaves, fields), "bpe-leaves")
    for _ in range(max(0, (most - 1).bit_length())):
        pairs = now.repartition("row", "seg", F.shiftright("leaf", 1)).sortWithinPartitions("row", "seg", "leaf")
        now = cut(pairs.mapInArrow(joins, fields), "bpe-level")

    def numbers(batches):
        for b in batches:
            ids = [(np.frombuffer(x, np.int64) - 1).astype("<u4").tobytes() for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], names=["row", "seg", "ids"])

    return now.select("row", "seg", "merged").mapInArrow(numbers, "row long, seg int, ids binary")


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", long_chars: int = 16384,
           leaf_bytes: int = 4096, decoded: bool = False) -> DataFrame:
    """``id, ids`` for every row: little-endian unsigned 32-bit integers, ``id`` under the name of ``id_col``.

    With ``decoded`` there's also the text that ``decode`` makes of the ids, in the same pass.

    Texts with a stretch of more than ``long_chars`` characters without ASCII white space go through the tree;
    each other text is encoded in one task.
    """
    base = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    is_long = (F.length("text") > long_chars) & F.col("text").rlike(f"[^ \\t\\n\\x0b\\f\\r]{{{long_chars + 1}}}")
    short = _encode_whole(base.where(~is_long), tokenizer_path, decoded)
    long = base.where(is_long)
    if long.isEmpty():
        return short.withColumnRenamed("id", id_col)
    parts = cut(_long_parts(long, tokenizer_path, leaf_bytes), "bpe-parts")
    merged = _merge_leaves(parts, tokenizer_path)
    heads = parts.where("leaf = 0").select("row", "id", "seg", "ids")
    ready = heads.where("ids is not null").unionByName(
        heads.where("ids is null").drop("ids").join(merged, ["row", "seg"]).select("row", "id", "seg", "ids"))

    def assemble(key, table):
        table = table.sort_by("seg")
        return pa.table({"id": table.column("id").slice(0, 1), "ids": pa.array([b"".join(table.column("ids").to_pylist())], pa.binary())})

    whole = ready.groupBy("row").applyInArrow(assemble, _schema(base, "id", IDS))
    if decoded:
        whole = decode(whole, tokenizer_path, "id")
    return short.unionByName(whole).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, ids, decoded``: the text of each row's ids, special tokens included (null ids: empty)."""
    def run(batches):
        bpe = WordBpe(tokenizer_path)
        for batch in batches:
            for b in _slices(batch):
                texts = [bpe.decode(x or b"").decode("utf-8", "replace") for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["id", "ids", "decoded"])

    base = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return base.mapInArrow(run, _schema(base, "id", IDS, DECODED)).withColumnRenamed("id", id_col)
