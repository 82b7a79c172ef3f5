"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Two tokenizers cut one text; a cut is a byte offset where tokens of both end. An
interval of tokens is split at a cut near its middle, which is found by bisecting the
other tokenizer's ends for the ends around the middle, and both halves go on; an
interval without an inner cut is a leaf: one group. All intervals of a batch of texts
go down one level at a time, so numpy does each level's bisects at once.

Corpus-wide pair counts, without moving a text or a document's pairs by key:

1. tasks encode and align texts; a block of texts becomes rows with their digests and
   their pairs as places in the block's list of distinct pairs, and rows of that list
   with the number of the block's documents a pair is linked in (written once);
2. those lists are summed per pair, the highest count is found per A id, and the counts
   go back to the blocks' lists: as many rows as distinct pairs a block, not a document;
3. each block meets its list and its documents read their counts by place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import bytebpe
from skuflow.llm.common import written

BLOCK_BYTES = 1 << 21     # bytes of text in a block, about
WIDE = 256                # links of a group that are listed one by one; wider groups count their ids first
B_BITS = 31               # bits of a pair's number: (A id) * (size of B) + (B id)
OUT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PieceModel:
    """A sentencepiece model with every token's bytes."""

    def __init__(self, proto: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace("▁", " ").encode("utf-8")
                      for i, n in enumerate(names)]
        # without a piece that goes on beyond the space after a word, words never merge with the next one
        self.sliced = not any("▁" in n.lstrip("▁") for n in names)

    def ids(self, text: str) -> np.ndarray:
        """Token ids of space+text (the model itself adds the space)."""
        parts = list(bytebpe.slices(text)) if self.sliced else [text]
        parts = [parts[0], *(p[1:] for p in parts[1:])]  # the model adds each later part's space again
        lists = list(map(self.library.encode, parts))
        return np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))


class Pair:
    """Both tokenizers, ready in a worker."""

    def __init__(self, spec: str, whole: frozenset[str], proto: bytes):
        self.a, self.b = bytebpe.ByteBPE(spec, whole), PieceModel(proto)
        size = max(self.a.vocab.values()) + 1
        a_bytes = [b""] * size
        for entry, i in self.a.vocab.items():
            try:
                a_bytes[i] = self.a.entry_bytes(entry)
            except KeyError:
                continue  # an added token: never used here
        self.a_bytes, self.b_bytes = a_bytes, self.b.bytes
        self.a_len = np.array(list(map(len, a_bytes)), np.int64)
        self.b_len = np.array(list(map(len, self.b_bytes)), np.int64)
        self.width = max(size, len(self.b_bytes))
        self.words: dict[str, int] = {}
        self.a_words, self.b_words = _Lists(), _Lists()
        if size * len(self.b_bytes) >= 1 << B_BITS:
            raise ValueError("the vocabularies' pairs do not fit their number")

    def given_back(self, a: list[int], b: list[int], full: bytes) -> bool:
        return (b"".join(map(self.b_bytes.__getitem__, b)) == full
                and b"".join(map(self.a_bytes.__getitem__, a)) == full)

    def both(self, text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for space+text, or None where a side's bytes are not those of space+text."""
        a, b = self.a.ids(" " + text), self.b.ids(text)
        return (a, b) if self.given_back(a.tolist(), b.tolist(), b" " + raw) else None

    def learn(self, words: list[str]) -> None:
        """Remember both encodings of space+word for all ``words``.

        A word that does not start right after its space is unsure: it depends on its text.
        """
        sure = [w for w in words if w and not (w[0].isspace() or "\x1c" <= w[0] <= "\x1f" or not w.isascii() and bytebpe.unnamed(w))]
        self.words |= dict.fromkeys(words, UNSURE)
        self.words |= zip(sure, range(self.a_words.n, self.a_words.n + len(sure)))
        if not sure:
            return
        pieces = self.a.split(" " + " ".join(sure))
        ids = np.fromiter(chain.from_iterable(map(self.a.lists.__getitem__, pieces)), np.int32)
        sizes = np.fromiter((len(w.encode("utf-8")) + 1 for w in sure), np.int64, len(sure))
        ends = np.searchsorted(np.cumsum(self.a_len[ids]), np.cumsum(sizes)) + 1
        self.a_words.add(ids, np.diff(ends, prepend=0))
        lists = self.b.library.encode(sure, num_threads=1)
        self.b_words.add(np.fromiter(chain.from_iterable(lists), np.int32), np.fromiter(map(len, lists), np.int64, len(sure)))

    def encoded(self, raws: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for every text, None where there are no tokens.

        Neither tokenizer merges across the space before a word, so a text whose spaces
        all stand before words is encoded word by word, and words are remembered.
        """
        texts = [bytebpe.plain_text(r) if r else None for r in raws]
        if not self.b.sliced:
            return [t and self.both(t, r) or None for t, r in zip(texts, raws, strict=True)]
        split = [t.split(" ") if t else [] for t in texts]
        new = {w for words in split for w in words} - self.words.keys()
        if len(self.words) + len(new) > WORDS:
            self.words.clear()
            self.a_words, self.b_words = _Lists(), _Lists()
            new = {w for words in split for w in words}
        self.learn(list(new))
        out: list = []
        for text, raw, words in zip(texts, raws, split, strict=True):
            at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            if not len(at):
                out.append(None)
            elif at.min() == UNSURE:
                out.append(self.both(text, raw))
            else:
                a, b = self.a_words.of(at), self.b_words.of(at)
                out.append((a, b) if self.given_back(a.tolist(), b.tolist(), b" " + raw) else None)
        return out


class _Lists:
    """Lists of ids behind one another."""

    def __init__(self) -> None:
        self.ids, self.starts, self.n = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        self.n += len(sizes)

    def of(self, lists: np.ndarray) -> np.ndarray:
        start = self.starts[lists]
        n = self.starts[lists + 1] - start
        return self.ids[_spread(n) + np.repeat(start, n)]


UNSURE = -1
WORDS = 1 << 19           # words that a worker remembers


@lru_cache(maxsize=1)
def _pair(spec: str, whole: frozenset[str], proto: bytes) -> Pair:
    return Pair(spec, whole, proto)


def groups(ea: np.ndarray, eb: np.ndarray, lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Leaf groups (A from, A to, B from, B to; ends exclusive) in order of the text.

    ``ea`` and ``eb`` are the byte offsets at which tokens end, rising over all texts
    of the batch; the intervals given end in a common end each (a text's own end).
    """
    leaves: list[tuple[np.ndarray, ...]] = []
    reach = np.zeros(len(lo_a), np.int64)  # how far around the middle an interval has been searched
    while len(lo_a):
        single = (hi_a - lo_a == 1) | (hi_b - lo_b == 1)
        if single.any():
            leaves.append((lo_a[single], hi_a[single], lo_b[single], hi_b[single]))
            go = ~single
            lo_a, hi_a, lo_b, hi_b, reach = lo_a[go], hi_a[go], lo_b[go], hi_b[go], reach[go]
            if not len(lo_a):
                break
        mid = (lo_a + hi_a - 2) >> 1
        first = np.maximum(lo_a, mid - reach)
        n = np.minimum(hi_a - 2, mid + reach) - first + 1
        start = np.cumsum(n) - n
        probe = np.arange(int(n.sum())) + np.repeat(first - start, n)
        at = np.searchsorted(eb, ea[probe])
        hit = eb[at] == ea[probe]
        far = np.where(hit, np.abs(probe - np.repeat(mid, n)) * 2 + (probe < np.repeat(mid, n)), np.iinfo(np.int64).max)
        best = np.minimum.reduceat(far, start)
        cut = best < np.iinfo(np.int64).max
        a_cut = np.where(best & 1 == 1, mid - (best >> 1), mid + (best >> 1))[cut] + 1
        b_cut = np.searchsorted(eb, ea[a_cut - 1]) + 1
        done = ~cut & (first == lo_a) & (first + n == hi_a - 1)
        if done.any():
            leaves.append((lo_a[done], hi_a[done], lo_b[done], hi_b[done]))
        # both halves of a cut interval, the others as they are, all still in order of the text
        go = ~done
        n = np.where(cut[go], 2, 1)
        parent = np.repeat(np.flatnonzero(go), n)
        right = (np.cumsum(n) - 1)[cut[go]]
        lo_a, hi_a, lo_b, hi_b, reach = lo_a[parent], hi_a[parent], lo_b[parent], hi_b[parent], 2 * reach[parent] + 1
        hi_a[right - 1] = lo_a[right] = a_cut
        hi_b[right - 1] = lo_b[right] = b_cut
        reach[right - 1] = reach[right] = 0
    if not leaves:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    la, ha, lb, hb = (np.concatenate(x) for x in zip(*leaves, strict=True))
    order = np.argsort(la, kind="stable")
    return la[order], ha[order], lb[order], hb[order]


def _spread(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for every n of ``counts``, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def linked(ids_a: np.ndarray, ids_b: np.ndarray, g: tuple[np.ndarray, ...], doc: np.ndarray, width_b: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links) of every id pair that a document links; ``doc`` is each group's document.

    Links of one pair inside a wide group are a product of two counts, never listed.
    """
    la, ha, lb, hb = g
    na, nb = ha - la, hb - lb
    small = na * nb <= WIDE
    n = (na * nb)[small]
    owner = np.repeat(np.flatnonzero(small), n)
    k = _spread(n)
    key = (doc[owner] << B_BITS) | (
        ids_a[la[owner] + k // nb[owner]].astype(np.int64) * width_b + ids_b[lb[owner] + k % nb[owner]])
    found, links = np.unique(key, return_counts=True)
    parts, weights = [found], [links]
    for i in np.flatnonzero(~small):
        a, ca = np.unique(ids_a[la[i]:ha[i]], return_counts=True)
        b, cb = np.unique(ids_b[lb[i]:hb[i]], return_counts=True)
        parts.append((doc[i] << B_BITS) | (a.astype(np.int64)[:, None] * width_b + b[None, :]).ravel())
        weights.append((ca[:, None] * cb[None, :]).ravel())
    if len(parts) > 1:
        key, back = np.unique(np.concatenate(parts), return_inverse=True)
        links = np.zeros(len(key), np.int64)
        np.add.at(links, back, np.concatenate(weights))
        found = key
    return found >> B_BITS, found & ((1 << B_BITS) - 1), links


@lru_cache(maxsize=2)
def _decimals(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of all numbers below ``width`` with room for a mark, and how many they are."""
    digits = len(str(width))
    table = np.array([str(i).ljust(digits + 1, "0").encode() for i in range(width)]).view(np.uint8).reshape(width, digits + 1)
    return table, np.array([len(str(i)) for i in range(width)])


def spelled(ids_a: np.ndarray, ids_b: np.ndarray, g: tuple[np.ndarray, ...], last: np.ndarray, width: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2`` of all groups as bytes, and where each group ends in them.

    ``last`` marks a text's last group, which gets no ``;``.
    """
    la, ha, lb, hb = g
    na, nb = ha - la, hb - lb
    n = na + nb
    at = np.cumsum(n) - n
    ids = np.empty(int(n.sum()), np.int64)
    ids[_spread(na) + np.repeat(at, na)] = ids_a[_spread(na) + np.repeat(la, na)]
    ids[_spread(nb) + np.repeat(at + na, nb)] = ids_b[_spread(nb) + np.repeat(lb, nb)]
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[at + na - 1] = ord("|")
    mark[at + n - 1] = ord(";")
    table, sizes = _decimals(width)
    text = table[ids]
    size = sizes[ids]
    text[np.arange(len(ids)), size] = mark
    size = size + 1
    size[(at + n - 1)[last]] -= 1
    ends = np.cumsum(size)[at + n - 1]
    return text[np.arange(table.shape[1])[None, :] < size[:, None]], ends


ROWS = pa.schema([("_block", pa.int64()), ("_row", pa.int64()), ("_n_a", pa.int64()), ("_n_b", pa.int64()), ("_n_groups", pa.int64()),
                  ("_n_links", pa.int64()), ("_sha", pa.string()), ("_places", pa.binary()), ("_links", pa.binary()),
                  ("_pairs", pa.list_(pa.int64())), ("_docs", pa.list_(pa.int32()))])
ROWS_DDL = ("_block long, _row long, _n_a long, _n_b long, _n_groups long, _n_links long, _sha string, _places binary, "
            "_links binary, _pairs array<long>, _docs array<int>")


def block_rows(pair: Pair, block: int, encoded: list[tuple[np.ndarray, np.ndarray] | None]) -> dict[str, list]:
    """A block's documents, and one row (``_row`` null) with its distinct pairs and their documents."""
    out: dict[str, list] = {n: [] for n in ROWS.names}
    full = [i for i, e in enumerate(encoded) if e is not None]
    done: dict[int, tuple] = {}
    pairs = docs = np.zeros(0, np.int64)
    if full:
        ids_a = np.concatenate([encoded[i][0] for i in full])
        ids_b = np.concatenate([encoded[i][1] for i in full])
        to_a = np.cumsum([len(encoded[i][0]) for i in full])
        to_b = np.cumsum([len(encoded[i][1]) for i in full])
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        g = groups(np.cumsum(pair.a_len[ids_a]), np.cumsum(pair.b_len[ids_b]), from_a, to_a, from_b, to_b)
        doc = np.searchsorted(to_a, g[0], side="right")
        to_g = np.searchsorted(doc, np.arange(len(full)), side="right")
        last = np.zeros(len(doc), bool)
        last[to_g - 1] = True
        text, ends = spelled(ids_a, ids_b, g, last, pair.width)
        n_links = np.bincount(doc, (g[1] - g[0]) * (g[3] - g[2]), len(full)).astype(np.int64)
        owner, pairs_of, links = linked(ids_a, ids_b, g, doc, len(pair.b_bytes))
        pairs, places = np.unique(pairs_of, return_inverse=True)
        docs = np.bincount(places, minlength=len(pairs))
        cut = np.searchsorted(owner, np.arange(len(full) + 1))
        body = text.tobytes()
        for k, i in enumerate(full):
            g0, t0 = (int(to_g[k - 1]), int(ends[to_g[k - 1] - 1])) if k else (0, 0)
            span = slice(int(cut[k]), int(cut[k + 1]))
            done[i] = (len(encoded[i][0]), len(encoded[i][1]), int(to_g[k]) - g0, int(n_links[k]),
                       hashlib.sha256(body[t0:int(ends[to_g[k] - 1])]).hexdigest(),
                       places[span].astype(np.int32).tobytes(), links[span].astype(np.int64).tobytes())
    for i in range(len(encoded)):
        for name, v in zip(ROWS.names, (block, i, *done.get(i, (0, 0, 0, 0, "", b"", b"")), None, None), strict=True):
            out[name].append(v)
    for name, v in zip(ROWS.names, (block, *[None] * 8, pairs, docs.astype(np.int32)), strict=True):
        out[name].append(v)
    return out


def pair_digests(docs: DataFrame, tokenizer_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``<id>``, then ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row.

    A null or empty text, and one that a tokenizer does not give back byte by byte, has
    no tokens: zeros and ''. Equal rows count as documents each; ids may be null or
    repeat; other columns are not read, whatever their names; an empty table gives none.
    Long texts are encoded some 65,000 characters at a time; a text larger than a block
    is a block of its own, so a worker holds one text's tokens and distinct pairs.
    Of two cuts equally far from an interval's middle the later one is taken; the
    groups do not depend on it.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    with open(model_path, "rb") as f:
        proto = f.read()
    whole = bytebpe.ByteBPE(spec).whole
    width_b = len(PieceModel(proto).bytes)
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_raw"))
    id_type = kept.schema["_id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(spec, whole, proto)
        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list = []
        size = 0

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal seq, size
            rows = block_rows(pair, (part << 32) | seq, pair.encoded(texts))
            out = pa.RecordBatch.from_arrays(
                [pa.array([*ids, None], id_type), *(pa.array(rows[f.name], f.type) for f in ROWS)], ["_id", *ROWS.names])
            seq, size = seq + 1, 0
            ids.clear()
            texts.clear()
            return out

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for i, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = raw.as_py()
                ids.append(i)
                texts.append(raw)
                size += len(raw or b"")
                if size >= block_bytes or len(ids) >= 1 << 14:
                    yield flush(kind)
        if ids:
            yield flush(kind)

    rows = written(kept.mapInArrow(align, f"_id {id_type}, {ROWS_DDL}"), "aligned")
    lists = rows.where(F.col("_row").isNull()).select("_block", F.explode(F.arrays_zip("_pairs", "_docs")).alias("_p")).select(
        "_block", F.col("_p._pairs").alias("_pair"), F.col("_p._docs").alias("_in"))
    counts = lists.groupBy("_pair").agg(F.sum("_in").alias("_count"))
    counts = written(counts, "pair-counts")
    top = counts.groupBy(F.expr(f"_pair div {width_b}").alias("_a")).agg(F.max("_count").alias("_top"))
    judged = counts.withColumn("_a", F.expr(f"_pair div {width_b}")).join(top, "_a").select(
        "_pair", "_count", (F.col("_count") == F.col("_top")).alias("_best"))
    back = lists.select("_block", "_pair").join(judged, "_pair").select(F.col("_block").alias("_to"), "_pair", "_count", "_best")
    whole_docs = rows.where(F.col("_row").isNotNull()).drop("_pairs", "_docs")

    def read(docs_: pa.Table, pairs_: pa.Table) -> pa.Table:
        # the block's list was in the order of its pairs
        order = np.argsort(pairs_.column("_pair").to_numpy(), kind="stable")
        count = pairs_.column("_count").to_numpy()[order]
        best = np.where(pairs_.column("_best").to_numpy(zero_copy_only=False)[order], 1, 0)
        n_best, total = [], []
        for p, k in zip(docs_.column("_places"), docs_.column("_links"), strict=True):
            at, links = np.frombuffer(p.as_py(), np.int32), np.frombuffer(k.as_py(), np.int64)
            n_best.append(int((best[at] * links).sum()))
            total.append(int((count[at] * links).sum()))
        names = ["_id", "_n_a", "_n_b", "_n_groups", "_n_links", "_sha"]
        cols = [docs_.column(n) for n in names]
        return pa.table([*cols[:5], pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), cols[5]],
                        [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return whole_docs.groupBy("_block").cogroup(back.groupBy("_to")).applyInArrow(read, f"`{id_col}` {id_type}, {OUT}")
