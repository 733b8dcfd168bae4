"""Documents packed into fixed-length token sequences, shortest pack first.

Every document becomes its token ids and an end id, cut into pieces of at most ``size``
ids. The histogram of piece lengths (at most ``size`` rows) is packed on the driver:
lengths go longest first, each into the shortest packs so far, and only counts of packing
patterns change. Pieces then get a rank within their length and find their place in a
pattern by that rank.

Nulls and edges: a null text counts as empty and yields the end id alone; a null doc_id is
carried along; repeated rows are pieces of their own; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from bisect import insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codesift.llm.common import blocks_for, with_rank
from codesift.session import written

SIZE = 2048
END_ID = 1
# Words of the newer half of those a worker keeps; a word takes some 150 bytes, and a worker
# outlives the stage.
_KEPT_WORDS = 150_000


class WordIds(dict):
    """Token ids, as little-endian 32-bit bytes, of each text between ASCII white space.

    White space parts the words of this kind of tokenizer and is then dropped, so ids of a
    text are those of its parts in order. Parts of common letters and signs go through a
    fast byte-pair coder with the tokenizer's own merges; all others through the tokenizer.
    """

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self._older: dict[bytes, bytes] = {}
        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ends = model["end_of_word_suffix"]
        byte_of = {c: b for b, c in _byte_letters().items()}

        def raw(token: str) -> bytes:
            # White space is never inside a word, so a blank can stand for its end.
            last = token.endswith(ends)
            body = token[: -len(ends)] if last else token
            return bytes(byte_of[c] for c in body) + (b" " if last else b"")

        letters = _byte_letters().values()
        order = [*letters, *(c + ends for c in letters)]
        order += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranks: dict[bytes, int] = {}
        ids: list[int] = []
        for token in order:
            if raw(token) not in ranks:
                ranks[raw(token)] = len(ids)
                ids.append(model["vocab"][token])
        self._ids = np.array(ids, "<u4")
        self._last = np.zeros(len(ids), bool)
        self._last[[r for word, r in ranks.items() if word.endswith(b" ")]] = True
        self._coder = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks,
                                        special_tokens={})
        # Fixed value: how the tokenizer parts words.
        self._parts = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self._common = regex.compile("[\x21-\x7e¡-įı-ɏ]+")

    def of(self, text: bytes) -> bytes:
        """The ids of a text."""
        parts = text.split()
        if new := {part for part in parts if part not in self and part not in self._older}:
            self._learn(new)
        return b"".join(map(self.__getitem__, parts))

    def _learn(self, parts: set[bytes]) -> None:
        if len(self) >= _KEPT_WORDS:
            # The older half goes; what is still in use comes back from it when asked for.
            self._older = dict(self)
            self.clear()
        plain, words, counts = [], [], []
        for part in parts:
            if part.isalpha():
                found = [part.lower().decode()]
            elif self._common.fullmatch(text := part.decode()) and "<|" not in text:
                found = self._parts.findall(text.lower())
            else:
                ids = self._whole.encode(text, add_special_tokens=False).ids
                self[part] = np.array(ids, "<u4").tobytes()
                continue
            plain.append(part)
            words += found
            counts.append(len(found))
        if plain:
            ranks = np.array(self._coder.encode_ordinary(" ".join(words) + " "), np.int64)
            # A word ends with each id whose text ends a word.
            ends = np.concatenate([[0], np.flatnonzero(self._last[ranks]) + 1])
            cuts = (4 * ends[np.concatenate([[0], np.cumsum(counts)])]).tolist()
            ids = self._ids[ranks].tobytes()
            for part, low, high in zip(plain, cuts, cuts[1:]):
                self[part] = ids[low:high]

    def __missing__(self, part: bytes) -> bytes:
        if part in self._older:
            self[part] = self._older[part]
        else:
            self._learn({part})
        return self[part]


@lru_cache(1)
def _words(tokenizer: str) -> WordIds:
    """One coder per Python worker, kept from task to task."""
    return WordIds(tokenizer)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies, in id order.

    Printable bytes stand for themselves; the others take the code points from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``.

    ``tokenizer`` is the path of a tokenizer file with word ends, the same on all machines.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        words = _words(tokenizer)
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py() or b""
                ids = memoryview(words.of(text) + end)
                total = len(ids) // 4
                for start in range(0, total, size):
                    piece = ids[4 * start: 4 * (start + size)]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(total)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        cut, schema)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE):
    """Patterns ``(count, [(length, copies), ...])`` that use up the histogram.

    Lengths go longest first. Each goes into the shortest packs as long as it fits there,
    and the rest opens new packs, filled with as many copies as they hold.
    """
    packs: dict[int, list] = {}
    totals: list[int] = []

    def put(total: int, count: int, pattern: list) -> None:
        if total not in packs:
            packs[total] = []
            insort(totals, total)
        packs[total].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and totals and totals[0] + length <= size:
            total = totals[0]
            count, pattern = packs[total].pop()
            if not packs[total]:
                del packs[total]
                totals.pop(0)
            used = min(count, left)
            if used < count:
                put(total, count - used, pattern)
            if pattern[-1][0] == length:
                grown = pattern[:-1] + [(length, pattern[-1][1] + 1)]
            else:
                grown = pattern + [(length, 1)]
            put(total + length, used, grown)
            left -= used
        each = size // length
        if left >= each:
            put(each * length, left // each, [(length, each)])
        if left % each:
            put(left % each * length, 1, [(length, left % each)])
    return [pack for total in totals for pack in packs[total]]


def slots(patterns) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, packs, first sequence, offset)`` of each run of a pattern."""
    taken: dict[int, int] = {}
    first, out = 0, []
    for count, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            low = taken.get(length, 0)
            out.append((length, low, count, first, offset))
            taken[length] = low + count * copies
            offset += copies * length
        first += count
    return out


def packed(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, both gapless from 0."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, size, end_id), "pieces")
    # At most one row per length reaches the driver.
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    by_length: dict[int, list] = {}
    for length, *slot in slots(shortest_pack_first(histogram, size)):
        by_length.setdefault(length, []).append(tuple(slot))
    places = spark.createDataFrame(
        list(by_length.items()),
        "_length long, _slots array<struct<low: long, packs: long, first: long, offset: long>>")
    ranked = with_rank(cut, ["length"], ["doc_id", "start"], "_rank",
                       blocks_for(sum(histogram.values())))
    slot = F.element_at(F.filter("_slots", lambda s: s["low"] <= F.col("_rank")), -1)
    # One row per length, and as many slots as patterns have runs: bounded by `size`.
    joined = ranked.join(F.broadcast(places), F.col("length") == F.col("_length")).withColumn(
        "_slot", slot).withColumn("_at", F.col("_rank") - F.col("_slot.low"))
    return joined.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_slot.first") + F.col("_at") % F.col("_slot.packs")).alias("sequence_id"),
        (F.col("_slot.offset") + F.floor(F.col("_at") / F.col("_slot.packs")) * F.col("length"))
        .cast("long").alias("offset"))
