"""Byte-pair encoding and decoding with exact tree concatenation.

White space always separates words in the vocabularies used here, so a word's
ids do not depend on its neighbours and each task encodes a word once.  A long
unsplit word is cut in halves down to leaves, the leaves are encoded apart, and
two neighbours are joined by encoding a window around the cut that grows until
its tokens agree with both sides; adjacent tokens that are right pairwise make
the one right encoding.  Leaves of very long texts are rows of their own, so
their encoding is spread over the cluster.
"""

from __future__ import annotations

import hashlib
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import worker_slot

#: Code points of a leaf, of the first window on either side of a cut, and of a
#: text whose leaves become rows.
LEAF, WINDOW, SPREAD = 4096, 32, 1 << 20
#: Bytes of words kept in each of a worker's two generations, by estimate: an
#: entry's objects take some 300 bytes besides its characters and ids.
MEMO, ENTRY = 96 << 20, 300
#: Punctuation that ends a word often; behind a letter it is a piece of its own.
TAIL = ".,;:!?%#*$&"


class Encoded:
    """Ids of a text with the code points each token stands for."""

    __slots__ = ("text", "ids", "spans")

    def __init__(self, text: str, ids: list[int], spans: list[tuple[int, int]]):
        self.text, self.ids, self.spans = text, ids, spans


def safe_cut(text: str, at: int) -> int:
    """A cut near ``at`` that no composition of characters spans; 0 if none is near."""
    for cut in range(at, min(at + 256, len(text))):
        pair = text[cut - 1 : cut + 1]
        if not unicodedata.combining(pair[1]) and unicodedata.normalize("NFC", pair) == "".join(
            unicodedata.normalize("NFC", c) for c in pair
        ):
            return cut
    return 0


def leaves_of(word: str, leaf: int) -> list[str]:
    """Halves of halves, each at most about ``leaf`` long."""
    if len(word) <= leaf:
        return [word]
    cut = safe_cut(word, len(word) // 2)
    return leaves_of(word[:cut], leaf) + leaves_of(word[cut:], leaf) if cut else [word]


class Codec:
    """Encoder over a tokenizer's JSON text."""

    def __init__(self, source: str, leaf: int = LEAF, window: int = WINDOW):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf, self.window = leaf, window
        # words met since the memory was full last, and those of the time before
        self.memo: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}
        self.held = 0

    def plain(self, text: str) -> Encoded:
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return Encoded(text, e.ids, e.offsets)

    def join(self, a: Encoded, b: Encoded) -> Encoded:
        """Exact encoding of ``a.text + b.text``."""
        text, cut, reach = a.text + b.text, len(a.text), self.window
        shifted = [(s + cut, e + cut) for s, e in b.spans]
        while True:
            lo, hi = max(0, cut - reach), min(len(text), cut + reach)
            if lo == 0 and hi == len(text):
                return self.plain(text)
            lo = lo and next((s for s, _ in reversed(a.spans) if s <= lo), 0)
            mid = self.plain(text[lo:hi])
            spans = [(s + lo, e + lo) for s, e in mid.spans]
            left = self._agree(list(zip(a.ids, a.spans)), list(zip(mid.ids, spans)), cut, False) if lo else (0, 0)
            right = self._agree(list(zip(b.ids, shifted)), list(zip(mid.ids, spans)), cut, True) if hi < len(text) else (len(b.ids), len(mid.ids))
            if left and right and left[1] <= right[1]:
                (i, p), (j, q) = left, right
                return Encoded(text, a.ids[:i] + mid.ids[p:q] + b.ids[j:], a.spans[:i] + spans[p:q] + shifted[j:])
            reach *= 2

    @staticmethod
    def _agree(side: list, mid: list, cut: int, after: bool) -> tuple[int, int] | None:
        """Places in ``side`` and ``mid`` where two tokens running are the same."""
        place = {x[1]: k for k, x in enumerate(mid)}
        order = range(len(side) - 1) if after else range(len(side) - 2, -1, -1)
        for i in order:
            s, e = side[i][1]
            if abs((s if after else e) - cut) > (mid[-1][1][1] - mid[0][1][0]) + 1:
                return None
            p = place.get((s, e))
            if p is not None and p + 1 < len(mid) and side[i] == mid[p] and side[i + 1] == mid[p + 1]:
                return (i, p)
        return None

    def tree(self, leaves: list[Encoded]) -> Encoded:
        while len(leaves) > 1:
            pairs = [self.join(leaves[k], leaves[k + 1]) for k in range(0, len(leaves) - 1, 2)]
            leaves = pairs + leaves[len(leaves) & ~1 :]
        return leaves[0]

    def word(self, word: str) -> tuple[bytes, str]:
        """Packed ids of a word and its decoded text."""
        known = self.memo.get(word)
        if known is None and (known := self.old.get(word)) is not None:
            self.keep(word, known)
        if known is None:
            core = word.rstrip(TAIL)
            if core and len(core) < len(word) and len(core[-1].lower()) == 1 and core[-1].isalpha() and core[-1].lower().isalpha():
                (a, x), (b, y) = self.word(core), self.word(word[len(core) :])
                known = (a + b, f"{x} {y}")
            else:
                parts = leaves_of(word, self.leaf)
                known = self.packed((self.plain(word) if len(parts) == 1 else self.tree([self.plain(p) for p in parts])).ids)
            if len(word) <= 64:
                self.keep(word, known)
        return known

    def keep(self, word: str, known: tuple[bytes, str]) -> None:
        """Remember a word; a full memory becomes the old one, so words that come
        often stay and the others go."""
        self.held += ENTRY + 2 * len(word) + len(known[0]) + 2 * len(known[1])
        if self.held > MEMO:
            self.old, self.memo, self.held = self.memo, {}, 0
        self.memo[word] = known

    def packed(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), self.tokenizer.decode(ids, skip_special_tokens=False)

    def text(self, text: str | None) -> tuple[bytes, str]:
        """Packed ids and decoded text of a whole text (null: empty)."""
        get, one = self.memo.get, self.word
        found = [get(w) or one(w) for w in (text or "").replace("\n", " ").split(" ") if w]
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[0]])


def codec_for(source: str, leaf: int, window: int) -> Codec:
    """One codec per worker and vocabulary."""
    key = ("codec", hashlib.sha256(source.encode()).digest(), leaf, window)
    return worker_slot(key, lambda: Codec(source, leaf, window))


def _units(text: str, leaf: int) -> list[tuple[int, str]]:
    """The text as units: number of a long word and one of its leaves, or a run of
    short words under a number of its own."""
    units: list[tuple[int, str]] = []
    run: list[str] = []
    size = number = 0

    def flush() -> None:
        nonlocal run, size, number
        if run:
            units.append((number, " ".join(run)))
            number += 1
        run, size = [], 0

    for word in text.replace("\n", " ").split(" "):
        if len(word) > leaf:
            flush()
            units.extend((number, p) for p in leaves_of(word, leaf))
            number += 1
        elif word:
            run.append(word)
            size += len(word) + 1
            if size > leaf * 16:
                flush()
    flush()
    return units


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"
FULL = "ids binary, decoded string"


def encode_texts(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", digest: bool = False,
    leaf: int = LEAF, window: int = WINDOW, spread: int = SPREAD,
) -> DataFrame:
    """One row per document with ``ids`` (packed little-endian 32-bit integers) and
    ``decoded``, or with their digests.

    ``vocabulary`` is the path of a tokenizer file on the driver; its text (a few
    MB, whatever the data) goes to the tasks.  Null and empty texts have no ids
    and decode to an empty text; ids may be null or repeated; an empty table gives
    no rows; other columns are not read.  Texts over ``spread`` code points are
    encoded unit by unit as rows and put together per document.
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    tail = DIGEST if digest else FULL

    def finish(ids: bytes, decoded: str) -> tuple:
        if not digest:
            return ids, decoded
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()

    kinds = [pa.int64(), pa.string(), pa.string()] if digest else [pa.binary(), pa.string()]
    names = [c.split()[0] for c in tail.split(", ")]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(source.value, leaf, window)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, len(texts), 256):
                out = [finish(*codec.text(t.as_py())) for t in texts[at : at + 256]]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 256], *columns], names=["doc_id", *names])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, t in zip(*(c.to_pylist() for c in batch.columns)):
                units = _units(t, leaf) or [(0, "")]
                yield pa.RecordBatch.from_pydict({
                    "row": [row] * len(units), "doc_id": pa.array([doc] * len(units), batch.column(1).type),
                    "nth": list(range(len(units))), "word": [w for w, _ in units], "unit": [u for _, u in units],
                })

    def encode_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(source.value, leaf, window)
        for batch in batches:
            ids, spans = [], []
            for u in batch.column(4).to_pylist():
                e = codec.plain(u)
                ids.append(struct.pack(f"<{len(e.ids)}I", *e.ids))
                flat = [x for s in e.spans for x in s]
                spans.append(struct.pack(f"<{len(flat)}I", *flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(spans, pa.binary())],
                                             names=["row", "doc_id", "nth", "word", "unit", "ids", "spans"])

    def together(table: pa.Table) -> pa.Table:
        codec = codec_for(source.value, leaf, window)
        rows = sorted(table.select(["nth", "word", "unit", "ids", "spans"]).to_pylist(), key=lambda r: r["nth"])
        words: dict[int, list[Encoded]] = {}
        for r in rows:
            flat = struct.unpack(f"<{len(r['spans']) // 4}I", r["spans"])
            ids = list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"]))
            words.setdefault(r["word"], []).append(Encoded(r["unit"], ids, list(zip(flat[::2], flat[1::2]))))
        done = [codec.packed(codec.tree(w).ids) for w in words.values()]
        out = finish(b"".join(d[0] for d in done), " ".join(d[1] for d in done if d[0]))
        return pa.Table.from_arrays([table.column("doc_id").slice(0, 1), *[pa.array([v], k) for v, k in zip(out, kinds)]],
                                    names=["doc_id", *names])

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, {tail}"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    long = F.coalesce(F.length("text") > spread, F.lit(False))
    few = rows.where(~long).mapInArrow(short, schema)
    units = (
        rows.withColumn("row", F.monotonically_increasing_id()).where(long).select("row", "doc_id", "text")
        .mapInArrow(cut, f"row long, doc_id {kind}, nth long, word long, unit string")
    )
    spread_out = units.repartition("row", "nth").mapInArrow(
        encode_units, f"row long, doc_id {kind}, nth long, word long, unit string, ids binary, spans binary"
    )
    return few.unionByName(spread_out.groupBy("row").applyInArrow(together, schema))


def decode_ids(ids: bytes, tokenizer) -> str:
    """Text of packed ids, as the library decodes them."""
    return tokenizer.decode(list(struct.unpack(f"<{len(ids) // 4}I", ids)), skip_special_tokens=False)
