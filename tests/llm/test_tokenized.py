"""Operators 11 and 13 against the tokenizer libraries and a plain-loop alignment."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from skuflow.llm import alignment, bytebpe, queries, tokens

from helpers import SF, empty, odd

P = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SPEC = open(A, encoding="utf-8").read()
TRICKY = [
    "", " ", "  ", "   x", "a  b", "a   b ", "a \n b", "a\n\n b", "a \nb\n", "x<|endoftext|>y <|endoftext|>", "<|endoftext|>", "don't we'll I'VE",
    "a▁b", "ﬁne ｆｕｌｌ", "नमस्ते दुनिया", "你好 世界", "\U0001F600 \U0001F601\U0001F600", "͸ \U0003d000 new", "1234567890123 3.14", "\x1c a\x1fb \x85 c",
    "tab\there\r\nline", "x" * 3000, "ab " * 40000 + "end", " " * 500 + "x", "\n" * 300, "é ‍  z", "a　 b 　c", "�",
]


@pytest.fixture(scope="module")
def bpe():
    return bytebpe.ByteBPE(SPEC)


def random_texts(n, seed=3):
    r = random.Random(seed)
    parts = ["the", " cat", "  ", "\n", "ing", "1", "23", "!?", "é", "ß", "界", "\U0001F600", "\t", "'s", "'t", " ", "x" * 9, " ", "<|endoftext|>"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(n)]


def test_counts_and_ids_are_the_library_s(bpe):
    texts = TRICKY + random_texts(2000)
    lib = Tokenizer.from_str(SPEC)
    assert [bpe.count(t) for t in texts] == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
    lib.encode_special_tokens = True
    assert [bpe.ids(t).tolist() for t in texts] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_whole_strings_encode_as_themselves(bpe):
    lib = Tokenizer.from_str(SPEC)
    lib.encode_special_tokens = True
    some = sorted(bpe.whole)[::37]
    assert all(len(lib.model.tokenize(bpe.spelled(t))) == 1 for t in some)
    assert "<|endoftext|>" not in bpe.whole and len(bpe.whole) > 40000


def test_splitter_agrees_with_the_library_on_every_named_character(bpe):
    named = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not bytebpe.unnamed(chr(c))]
    for i in range(0, len(named), 5000):
        text = "".join(f"a{c}1{c} {c}" for c in named[i:i + 5000])
        assert bpe.split(text) == [text[a:b] for _, (a, b) in bpe.library.pre_tokenizer.pre_tokenize_str(text)]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bytebpe.ByteBPE(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())


def brute_groups(ends_a, ends_b):
    shared = set(ends_a) & set(ends_b)
    out, i, j = [], 0, 0
    for k in sorted(shared):
        i2, j2 = ends_a.index(k) + 1, ends_b.index(k) + 1
        out.append((i, i2, j, j2))
        i, j = i2, j2
    return out


def test_groups_of_random_cuts():
    r = random.Random(8)
    for _ in range(400):
        n = r.choice([1, 2, 5, 40, 300])
        ends_a = sorted({n, *(r.randrange(1, n + 1) for _ in range(r.randrange(n + 1)))})
        ends_b = sorted({n, *(r.randrange(1, n + 1) for _ in range(r.randrange(n + 1)))})
        one = [np.array([x]) for x in (0, len(ends_a), 0, len(ends_b))]
        got = alignment.groups(np.array(ends_a), np.array(ends_b), *one)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == brute_groups(ends_a, ends_b)


def test_a_wide_group_lists_no_links():
    # 3,000 tokens of one id against 2,000 of two: 6 million links, two pairs
    a, b = np.zeros(3000, np.int32), np.array([1, 2] * 1000, np.int32)
    g = tuple(np.array([x]) for x in (0, 3000, 0, 2000))
    doc, pairs, links = alignment.linked(a, b, g, np.array([5]), 10)
    assert (doc.tolist(), pairs.tolist(), links.tolist()) == ([5, 5], [1, 2], [3_000_000, 3_000_000])


def brute_alignment(texts):
    lib = Tokenizer.from_str(SPEC)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {v: k for k, v in enumerate(bytebpe.byte_letters())}
    links, heads = [], []
    for t in texts:
        a = lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        ba = [bytes(letters[c] for c in lib.id_to_token(i)) for i in a]
        bb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        full = (" " + (t or "")).encode()
        if not t or b"".join(ba) != full or b"".join(bb) != full:
            links.append(Counter())
            heads.append((0, 0, 0, ""))
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        at_a, at_b = {e: i for i, e in enumerate(ea)}, {e: i for i, e in enumerate(eb)}
        here, text, i, j = Counter(), [], 0, 0
        for e in sorted(at_a.keys() & at_b.keys()):
            ga, gb = a[i:at_a[e] + 1], b[j:at_b[e] + 1]
            here.update((x, y) for x in ga for y in gb)
            text.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            i, j = at_a[e] + 1, at_b[e] + 1
        links.append(here)
        heads.append((len(a), len(b), len(text), hashlib.sha256(";".join(text).encode()).hexdigest()))
    count = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [(*h[:3], sum(c.values()), sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()), h[3])
            for h, c in zip(heads, links, strict=True)]


COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block", [alignment.BLOCK_BYTES, 2000])
def test_alignment_against_plain_loops(spark, block):
    texts = [None, *TRICKY, *random_texts(60), "the cat sat on the mat. " * 20, "the cat sat on the mat. " * 20]
    docs = spark.createDataFrame([(i, t, "en", 7) for i, t in enumerate(texts)], "doc_id long, text string, _block string, n_a int").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in alignment.pair_digests(docs, A, B, block_bytes=block).collect()}
    want = brute_alignment(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_op11_over_its_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in queries.op11_cross_tokenizer_alignment(spark, SF).collect()}
    assert got == dict(zip(texts, brute_alignment(list(texts.values())), strict=True))


def test_op13_over_its_table(spark):
    lib = Tokenizer.from_str(SPEC)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes = [len(e.ids) for e in lib.encode_batch([r["text"] or "" for r in docs], add_special_tokens=False)]
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), n, n > 512) for r, n in zip(docs, sizes, strict=True))
    assert sorted(tuple(r) for r in queries.op13_token_counts(spark, SF).collect()) == want


def test_odd_rows(spark):
    rows = tokens.token_counts(odd(spark), A).collect()
    assert len(rows) == 12 and tokens.token_counts(empty(spark), A).count() == 0
    assert [(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows if r["doc_id"] == 1] == [(0, 0, False)]
    aligned = alignment.pair_digests(odd(spark), A, B).collect()
    assert len(aligned) == 12 and alignment.pair_digests(empty(spark), A, B).count() == 0
    assert [tuple(r)[1:] for r in aligned if r["doc_id"] == 2] == [(0, 0, 0, 0, 0, 0, "")]
    seven = [tuple(r) for r in aligned if r["doc_id"] == 7]
    assert len(seven) == 2 and seven[0] == seven[1] and seven[0][6] > 0
