"""Token alignment against a brute-force version with freshly loaded tokenizers."""

import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tenorgrid.llm import alignment
from tenorgrid.llm.alignment import Aligner, aligned, byte_values
from tenorgrid.llm.tokens import tokenizer_path
from tests.llm import helpers as h

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", " a", "a ", "a  b", "\ta\n\nb \n", "x\n y", "▁", "a ▁x b", "①㍿ﬁ", "é ẹ́ naïve", "😀👩‍👩‍👧 x😀", "中文字符 混ぜ書き",
         "end <|endoftext|> here", "<|endoftext|>", "<s>x</s><unk>", "a\x00b", "don't WE'LL 12345 678", "a　b c", "\U00010348́ ק",
         "'s 's", "a\u0085b   c", "x" * 3000, "<0x0A> \\n"]


def brute(texts: list[str | None]) -> list[tuple]:
    tok, sp, value = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_values()
    tok.encode_special_tokens = True
    docs = []
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        x = [bytes(value[c] for c in tok.id_to_token(i)) for i in a]
        y = [bytes([i - sp.piece_to_id("<0x00>")]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            docs.append(([], [], [], []))
            continue
        ends = [[sum(map(len, z[: k + 1])) for k in range(len(z))] for z in (x, y)] if len(x) < 500 else None
        if ends is None:
            ends = []
            for z in (x, y):
                n, e = 0, []
                for w in z:
                    n += len(w)
                    e.append(n)
                ends.append(e)
        of_a, of_b = dict(zip(ends[0], range(len(a)))), dict(zip(ends[1], range(len(b))))
        common = sorted(of_a.keys() & of_b.keys())
        groups, p, q = [], 0, 0
        for e in common:
            i, j = of_a[e] + 1, of_b[e] + 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
            p, q = i, j
        docs.append((a, b, groups, [(a[of_a[e]], b[of_b[e]]) for e in common]))
    count = Counter(pair for d in docs for pair in d[3])
    most = defaultdict(int)
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(len(a), len(b), len(g), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, g, links in docs]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def expected(rows):
    return sorted(((d, *f) for (d, *_), f in zip(rows, brute([r[1] for r in rows]))), key=repr)


@pytest.mark.parametrize("share", [1 << 16, 50, 1])
def test_aligned(spark, monkeypatch, share):
    """Also where few pairs, or none, count as frequent."""
    monkeypatch.setattr(alignment, "SHARE", share)
    rows = [*h.corpus(), *((1000 + k, t, None) for k, t in enumerate(TEXTS)), (None, "null id here", None), (1005, "a ▁x b", None)]
    documents, pairs = aligned(h.table(spark, rows))
    assert documents.columns == COLUMNS
    assert rows_of(documents) == expected(rows)
    assert pairs.agg({"count": "sum"}).first()[0] == documents.agg({"n_links": "sum"}).first()[0]
    assert pairs.select("a_id", "b_id").distinct().count() == pairs.count()


def test_empty_table(spark):
    documents, pairs = aligned(h.table(spark, []))
    assert documents.count() == 0 and pairs.count() == 0
    documents, pairs = aligned(h.table(spark, [(1, None, None), (2, "", None)]))
    assert rows_of(documents) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")] and pairs.count() == 0


@pytest.fixture(scope="module")
def one():
    return Aligner(A, B)


@given(st.lists(st.text(st.one_of(st.sampled_from("  \n▁é①😀ab'."), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=8))
@settings(max_examples=200, deadline=None)
def test_units_equal_whole_texts(one, texts):
    import pyarrow as pa

    sizes, hashes, owner, pairs, number = one.documents(pa.array(texts, pa.string()))
    for k, (t, want) in enumerate(zip(texts, brute(texts))):
        assert (*sizes[:, k].tolist(), hashes[k]) == (*want[:3], want[6])
        assert number[owner == k].sum() == want[3]


def test_units_that_are_known_or_forgotten(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "KNOWN", 40)
    fresh = Aligner(A, B)
    texts = [h.prose(80, k % 7, 60) for k in range(30)]
    texts = [t.replace("\n", " ") for t in texts]
    for _ in range(3):
        sizes, hashes, *_ = fresh.documents(pa.array(texts))
        assert [(*sizes[:, k].tolist(), hashes[k]) for k in range(30)] == [(*f[:3], f[6]) for f in brute(texts)]


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{h.FOLDER}/documents.parquet").collect()]
    assert rows_of(alignment.op13_token_alignment(spark, h.FOLDER)) == expected(docs)
