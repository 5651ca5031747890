"""Sentence pieces, fill-in-middle and centroid clustering against the library and plain loops on awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.errors import PythonException

from plinth.llm import clustering, fill_middle, sentence_pieces
from plinth.llm.queries import QUERIES
from plinth.runtime import cut
from tests.conftest import SF_DIR
from tests.llm.data import awkward

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ROWS = [(r[0], r[1]) for r in awkward()] + [
    (40, "  two  spaces   and▁▁ a mark ▁"), (41, "\n\n \t x\r\n"), (42, "\x00\x1c 𝒳𝒴 ﬁ Ａ é é ​　中文字符 日本語のテキスト"),
    (43, "ab<P>cd"), (44, "<S>"), (45, "ends in <M>"), (46, "<<P"), (47, "a <S b> P> <P <M"), (48, " "), (49, "x" * 5000 + " ".join("yz" * 300)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, 5, "clash", "clash") for d, t in ROWS]
    return cut(spark.createDataFrame(rows, "doc_id long, text string, n long, ids string, output string"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_sentence_pieces(spark, docs, library):
    got = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL), MODEL)
    ids = {t: library.encode(t or "", add_eos=True) for _, t in ROWS}
    assert ordered(got.select("doc_id", "ids", "decoded").collect()) == ordered((d, ids[t], library.decode(ids[t])) for d, t in ROWS)
    assert sentence_pieces.encode(docs, MODEL, end=False).where("doc_id = 5").first().ids == []
    assert sentence_pieces.encode(docs.limit(0), MODEL).collect() == []
    null = spark.createDataFrame([(1, None, "old"), (2, [264, 2], "old")], "doc_id long, ids array<int>, decoded string")
    assert ordered(sentence_pieces.decode(null, MODEL).select("doc_id", "decoded").collect()) == [(1, None), (2, "a")]


def test_sentence_pieces_of_the_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op11_sentence_pieces"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_eos=True)
        assert tuple(r)[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_agenda(library):
    """The agenda against the plain rule: the best-scored, leftmost pair becomes one symbol, again and again."""
    coder, rng = sentence_pieces.SentencePieces(MODEL), random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices("▁aeinorst▁hlcdT1.é\n", k=rng.randint(1, 40)))
        symbols = list(text)
        while pairs := [(coder.order[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in coder.order]:
            _, i = min(pairs)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        assert coder.merged(text) == symbols
        assert np.frombuffer(coder.encode([text])[0], "<i4").tolist() == library.encode(text)


def test_parts_together_and_alone():
    coder, rng = sentence_pieces.SentencePieces(MODEL), random.Random(6)
    parts = ["".join(rng.choices("▁aeinorsthlcd" if n % 3 else "▁a字中é日x𝒳qz", k=rng.randint(1, sentence_pieces.SHORT))) for n in range(2000)]
    assert coder.merged_together(parts) == [coder.merged_alone(p) for p in parts]
    assert coder.merged_together(["𝒳"]) == [coder.merged_alone("𝒳")]


def test_checked_slices(library):
    coder, rng = sentence_pieces.SentencePieces(MODEL), random.Random(5)
    for limit in (1, 7, 50):
        for _ in range(60):
            text = "".join(rng.choices("  ab▁\nthe", k=200))
            cuts = coder.slices(text, limit)
            assert list(itertools.chain.from_iterable(library.encode(cuts))) == library.encode(text)
            coder.check([text], [np.array(library.encode(text), dtype="<i4").tobytes()])
    assert len(coder.slices("ab " * 100, 50)) > 3 and coder.slices("x" * 100, 50) == ["x" * 100]
    with pytest.raises(ValueError, match="differ"):
        coder.check(["a b"], [np.array([264], dtype="<i4").tobytes()])


class Watched:
    """The library, with the characters that it was given to encode and, if asked for, other rewriting."""

    def __init__(self, library, rewrite=None):
        self.library, self.rewrite, self.seen = library, rewrite, 0

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode(self, texts, **options):
        self.seen += sum(map(len, texts))
        return self.library.encode(texts, **options)

    def normalize(self, text):
        return (self.rewrite or (lambda t: t))(self.library.normalize(text))


def test_known_parts_are_not_encoded_again(monkeypatch, library):
    coder = sentence_pieces.SentencePieces(MODEL)
    monkeypatch.setattr(sentence_pieces, "sentence_pieces", lambda path: coder)
    coder.library = watched = Watched(library)
    texts = [t for _, t in ROWS if not t or max(map(len, coder.parts.findall(t))) <= sentence_pieces.SHORT]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    for found in sentence_pieces._encoded(MODEL, True)([batch] * 10):
        assert found.column(1).to_pylist() == [library.encode(t or "", add_eos=True) for t in texts]
    assert 0 < watched.seen < sum(len(t or "") for t in texts)


@pytest.mark.parametrize("parts,ids", [(40, 10**6), (10**6, 60), (1, 1)])
def test_forgotten_parts(monkeypatch, library, parts, ids):
    monkeypatch.setattr(sentence_pieces, "CACHED_PARTS", parts)
    monkeypatch.setattr(sentence_pieces, "CACHED_IDS", ids)
    coder, rng = sentence_pieces.SentencePieces(MODEL), random.Random(9)
    words = ["".join(rng.choices("aeinorst中é\n▁x", k=rng.choice((2, 5, 9, 60)))) for _ in range(150)]
    for _ in range(60):
        texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(4)]
        assert [np.frombuffer(x, "<i4").tolist() for x in coder.encode(texts)] == library.encode(texts)
        assert max(map(len, coder.known), default=0) <= sentence_pieces.SHORT
    assert len(coder.known) < 1000 and len(coder.flat) < 20_000


def test_differences_from_the_library_are_errors(monkeypatch, library):
    coder = sentence_pieces.SentencePieces(MODEL)
    with monkeypatch.context() as patch:
        patch.setattr(coder, "merged_together", lambda parts: [coder.merged_alone(p[::-1]) for p in parts])
        with pytest.raises(ValueError, match="differ"):
            coder.encode(["some words", "zebra stone"])
    with monkeypatch.context() as patch:
        patch.setattr(coder, "library", Watched(library, lambda t: t.replace("é", "e")))
        with pytest.raises(ValueError, match="rewrites"):
            coder.encode(["plain", "café"])
    texts = ["some words", "zebra stone", "", "café 中\n文"]
    assert [np.frombuffer(x, "<i4").tolist() for x in coder.encode(texts)] == library.encode(texts)
    parts = ["▁", "\n", "▁▁", "some", "▁中", "x" * 60]
    ids = [coder.merged_alone(p) for p in parts]
    coder.check_parts(parts, ids)
    for i in range(len(parts)):
        with pytest.raises(ValueError, match="differ"):
            coder.check_parts(parts, ids[:i] + [ids[i] + ids[0]] + ids[i + 1:])


def plain_units(text):
    return re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)


def plain_transform(doc_id, text, seed, share, first):
    units, text = plain_units(text or ""), text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= share:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("seed,share,first", [(42, 50, 80), (1, 100, 0), (2, 100, 100), (3, 0, 50)])
def test_fill_in_middle(docs, seed, share, first):
    found = fill_middle.fill_in_middle(docs, seed, share, first)
    got = found.select("*", fill_middle.restored(found.output, found.form).alias("text")).collect()
    assert ordered(tuple(r)[:-1] for r in got) == ordered(plain_transform(d, t, seed, share, first) for d, t in ROWS)
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter((d, t or "") for d, t in ROWS)
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []


def test_units_of_a_very_long_text():
    text = " \n".join(["word"] * 400_000) + "\t" * 100_000
    n, form, a, b, output = fill_middle.transform(text, [7, 400_001, 0, 99], 50, 80)
    assert (n, form, a, b) == (400_001, "psm", 4 + 6 * 6, len(text) - 40) and output.startswith("<P>word \nword")


def vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    rows += [(i, [0.25, -0.5, 0.0, 1.0]) for i in range(300, 420)] + [(7, [0.25, -0.5, 0.0, 1.0]), (7, rows[7][1]), (None, [1.0] * 4)]
    rows += [(500, None), (501, [1.0, None, 2.0, 0.0]), (502, [math.nan] * 4), (503, [math.inf, 0.0, 0.0, 0.0]), (504, []), (505, [0.0] * 5)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS id", "'y' AS vector", "0 AS cluster")


def plain_clusters(kept, centroids, rounds):
    def assign(centroids):
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for (_, k), (_, v) in zip(assign(centroids), kept):
            members[k].append(v)
        centroids = [[sum(x) // len(members[k]) for x in zip(*members[k])] if k in members else c for k, c in enumerate(centroids)]
    last = assign(centroids)
    sums = collections.Counter()
    for d, k in last:
        sums[k] += d
    return [(i, k, d, sums[k], sum(sums.values()), centroids[k]) for (d, k), (i, _) in zip(last, kept)]


@pytest.mark.parametrize("count,rounds,rows", [(9, 5, 1 << 13), (9, 5, 7), (1, 2, 64), (600, 1, 64)])
def test_clusters(spark, monkeypatch, count, rounds, rows):
    monkeypatch.setattr(clustering, "ROWS", rows)
    table = vectors(spark).repartition(5)
    kept = cut(clustering.whole_vectors(table, "vec_id", "embedding", 4, 256))
    plain = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in table.collect()
             if r.embedding and len(r.embedding) == 4 and all(x is not None and math.isfinite(x) for x in r.embedding)]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    first = [v for _, v in sorted(plain, key=lambda r: (digest(r[0]), r[1]))[:count]]
    assert ordered(kept.collect()) == ordered(plain)
    assert clustering.first_centroids(kept, count, 2) == first
    got = clustering.clusters(kept, first, rounds).collect()
    assert ordered(got) == ordered(plain_clusters(plain, first, rounds))


def test_clusters_of_nothing_and_of_large_values(spark):
    table = clustering.whole_vectors(vectors(spark).limit(0), "vec_id", "embedding", 4, 256)
    assert clustering.first_centroids(table, 3, 2) == [] and clustering.clusters(table, [], 5).collect() == []
    assert clustering.clusters(table, [[1, 2, 3, 4]], 2).collect() == []
    for big in (1e8, -1e8, -1e300, 1e300):
        rows = spark.createDataFrame([(1, [big] * 4)], "vec_id long, embedding array<double>")
        held = clustering.whole_vectors(rows, "vec_id", "embedding", 4, 256)
        with pytest.raises(PythonException, match="64 bits"):
            clustering.clusters(held, [[0, 0, 0, 0]], 1).collect()
