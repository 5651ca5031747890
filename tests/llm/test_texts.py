"""Text operators against plain Python on awkward rows and on the smallest tables."""

import base64
import collections
import hashlib
import math
import random
import time
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plinth.llm import byte_pairs, licenses, lm, near_dups, packing, substrings, token_files, toxicity, words
from plinth.llm.queries import ORACLE_SQL, QUERIES
from plinth.runtime import cut, scratch
from tests.conftest import SF_DIR
from tests.llm.data import awkward, frame
from tests.oracle import normal

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ROWS = [(r[0], r[1]) for r in awkward()]


@pytest.fixture(scope="module")
def docs(spark):
    return cut(frame(spark))


@pytest.fixture(scope="module")
def nothing(spark):
    return cut(frame(spark, []))


def own_ids(text, end):
    own_ids.tokenizer = getattr(own_ids, "tokenizer", None) or Tokenizer.from_file(VOCABULARY)
    return own_ids.tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def raw(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_near_duplicates(docs, nothing):
    rule = near_dups.Threshold(80, 100)
    sets = []
    for _, text in ROWS:
        words = WORD.findall((text or "").translate(LOW))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = {d: d for d, _ in ROWS if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, _) in enumerate(ROWS):
        for j, (b, _) in enumerate(ROWS[:i]):
            shared = len(sets[i] & sets[j])
            if None not in (a, b) and shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    expected = [(d, len(s), d if d is None else find(d), d is None or find(d) == d) for (d, _), s in zip(ROWS, sets)]
    got = [tuple(r) for r in near_dups.near_duplicates(docs, rule).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert near_dups.near_duplicates(nothing, rule).collect() == []


def test_near_duplicates_of_crowds(spark, monkeypatch):
    """Many noisy copies of one text, a passage that most texts share, and chains of links; hot values from 8 on."""
    monkeypatch.setattr(near_dups, "HOT_LEAST", 8)
    monkeypatch.setattr(near_dups, "HOT_VALUES", 1_000_000)
    rng = random.Random(2)
    base, passage = [f"w{i}" for i in range(90)], [f"p{i}" for i in range(25)]
    rows = []
    for d in range(160):
        words = list(base) if d < 90 else [f"u{d}x{i}" for i in range(60)] + passage
        for _ in range(rng.randint(0, 4) if d < 90 else 0):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, t in rows for w in [t.split()]}
    root = dict(zip(sets, sets))

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dups.Threshold(85, 100))
    assert {r.doc_id: r.component_id for r in got.collect()} == {d: find(d) for d in sets}


def test_substrings(docs, nothing):
    words = [WORD.findall(t or "") for _, t in ROWS]
    first = {}
    for (d, _), own in zip(ROWS, words):
        for i in range(len(own) - 12 if d is not None else 0):
            key = tuple(own[i:i + 13])
            first[key] = min(d, first.get(key, d))
    expected = []
    for (d, _), own in zip(ROWS, words):
        gone = {i + k for i in range(len(own) - 12) if d is not None and first[tuple(own[i:i + 13])] < d for k in range(13)}
        expected.append((d, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    got = [tuple(r) for r in substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert substrings.without_repeats(nothing, carry=("lang",)).collect() == []


def test_token_files(spark, docs, nothing):
    folder = scratch(spark, "tokens")
    token_files.write_tokens(docs, folder, VOCABULARY, end_id=1)
    got = token_files.read_tokens(spark, folder).orderBy("start").collect()
    expected = sorted(((d, raw(own_ids(t, 1))) for d, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in expected]
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in got) == sorted((repr(d), x) for d, x in expected)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    manifest = spark.read.parquet(f"{folder}/manifest").orderBy("shard").first()
    with open(f"{folder}/dictionary.bin", "rb") as source:
        shard = token_files.Shard(f"{folder}/shards/{manifest['name']}", source.read())
    assert raw(shard.ids(len(shard) - 1)) == bytes(got[len(shard) - 1].ids)
    with pytest.raises(ValueError):
        token_files.Shard(f"{folder}/shards/{manifest['name']}", b"another dictionary")
    empty = scratch(spark, "tokens")
    token_files.write_tokens(nothing, empty, VOCABULARY, end_id=1)
    assert token_files.read_tokens(spark, empty).collect() == []


def test_packing(docs, nothing):
    found = packing.pack(cut(packing.pieces(docs, VOCABULARY, 2, 64)), ["doc_id", "start"], 64).collect()
    per = collections.defaultdict(list)
    for r in found:
        per[r.sequence_id].append((r.offset, r.length))
    assert sorted(per) == list(range(len(per)))
    for own in per.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist() and sum(n for _, n in own) <= 64
    ids = sorted((repr(d), own_ids(t, 2)) for d, t in ROWS)
    whole = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r.start):
        whole[repr(r.doc_id), r.doc_tokens].append(bytes(r.ids))
    once = {(k, len(x)): raw(x) for k, x in ids}
    for key, parts in whole.items():
        if key[0] not in ("None", "15", "19"):
            assert b"".join(parts) == once[key]
    assert sum(r.length for r in found) == sum(len(x) for _, x in ids)
    assert packing.pack(cut(packing.pieces(nothing, VOCABULARY, 2)), ["doc_id", "start"]).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 512): rng.randint(1, 4000) for _ in range(rng.randint(1, 200))}
    found = packing.plan(histogram, 512)
    fill = np.zeros(found.sequences, dtype=np.int64)
    ends = np.append(found.rank[1:], sum(histogram.values()))
    rank = {n: r for n, r in found.first_rank.items()}
    lengths = sorted(rank, key=rank.get)
    edges = [rank[n] for n in lengths] + [sum(histogram.values())]
    for lo, hi, first, offset in zip(found.rank, ends, found.sequence, found.offset):
        length = lengths[np.searchsorted(edges, lo, side="right") - 1]
        assert (fill[first:first + hi - lo] == offset).all()
        fill[first:first + hi - lo] += length
    assert fill.max() <= 512 and fill.sum() == sum(n * c for n, c in histogram.items())
    halves = sum(c for n, c in histogram.items() if n > 256)  # no two of these share a sequence
    assert found.sequences <= 1.2 * max(halves, fill.sum() / 512) + 2


def test_byte_pairs(docs, nothing):
    with open(RANKS[0], "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=RANKS[1], mergeable_ranks=ranks, special_tokens={})
    for size in ((1 << 15, 512), (100, 7)):
        got = byte_pairs.decode(byte_pairs.encode(docs, *RANKS, *size), *RANKS).collect()
        assert sorted((repr(r.doc_id), list(r.ids)) for r in got) == sorted((repr(d), plain.encode_ordinary(t or "")) for d, t in ROWS)
        assert sorted((repr(r.doc_id), r.decoded.decode()) for r in got) == sorted((repr(d), t or "") for d, t in ROWS)
    assert byte_pairs.encode(nothing, *RANKS).collect() == []


def test_stitching():
    coder, rng = byte_pairs.BytePairs(*RANKS), random.Random(3)
    letters = list("ab  \n\n\t'sdé中１2.,! \u0085\x1c\x1d　́𝒳") + ["'s", " a", "   ", "abcdefgh", "'ll"]
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        size, overlap = rng.choice([(4, 2), (10, 1), (12, 12), (9, 20)])
        starts = list(range(0, len(text), size)) or [0]
        found = [[s + b for b in coder.boundaries(text[s:s + size + overlap])] for s in starts]
        cuts = byte_pairs.stitch(coder, text, starts, found, size + overlap)
        assert b"".join(coder.encode(text[a:b]) for a, b in zip(cuts, cuts[1:])) == coder.encode(text)


def test_licenses(docs, nothing):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [(p.label, p.word) for p in got[17].places] == [("cc-by", 11), ("reserved", 8), ("reserved", 13)]
    assert [(b.label, b.line, b.share) for b in got[17].blocks] == [("apache-2.0", 0, 1.0)]
    assert got[4].n_words == got[5].n_words == 0 and not got[4].places
    assert licenses.scan(nothing).collect() == []


def license_labels(spark, texts):
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [[(b.label, b.line, round(b.share, 2)) for b in r.blocks] for r in sorted(found, key=lambda r: r.doc_id)]


def test_licenses_by_telling_words(spark):
    others = [
        "Released under the BSD License.", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under the GNU General Public License, version 2", "Licensed under the Apache License, Version 1.0",
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "This work has not been released into the public domain",
        f"It was released {'and ' * 9} under {'and ' * 9} the {'and ' * 9} mit {'and ' * 9} license",
    ]
    assert license_labels(spark, others) == [[]] * len(others)
    same = {
        "This program is licensed under the GNU General Public License v3": ("gpl-3.0", 0, 0.75),
        "This work is licensed under version 3 of the GNU General Public License": ("gpl-3.0", 0, 1.0),
        "Released under MIT License": ("mit", 0, 0.8), "x\nnot sold. Licensed under the Apache License 2.0": ("apache-2.0", 1, 0.88),
        "The work has been released into the public domain": ("public-domain", 0, 0.89),
    }
    assert license_labels(spark, list(same)) == [[x] if x[2] >= 0.8 else [] for x in same.values()]
    assert license_labels(spark, [f"{t} {t}" for t in licenses.TEMPLATES.values()]) == [[(k, 0, 1.0)] * 2 for k in licenses.TEMPLATES]


def test_licenses_across_lines(spark):
    wrapped = {
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided": ("bsd", 0, 1.0),
        "a\n\n# Licensed under the Apache License,\n# Version 2.0 (the": ("apache-2.0", 2, 1.0),
        "Copyright\nReleased under the\r\n\tMIT License": ("mit", 1, 1.0),
        "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and": ("mit-grant", 0, 1.0),
        "Licensed under CC\nBY-NC\n4.0": ("cc-by-nc-4.0", 0, 1.0),
    }
    assert license_labels(spark, list(wrapped)) == [[x] for x in wrapped.values()]
    for label, template in licenses.TEMPLATES.items():
        own = template.split()
        texts = [f"é {' '.join(own[:k])}\n{' '.join(own[k:])}\nend" for k in range(1, len(own))]
        assert license_labels(spark, texts) == [[(label, 0, 1.0)]] * len(texts)


def test_license_filters_lose_nothing():
    rng = random.Random(4)
    words = [f"t{i}" for i in range(14)]
    for _ in range(400):
        templates = {f"l{i}": " ".join(rng.sample(words, rng.randint(1, 8))) for i in range(4)}
        index = licenses.Index(templates, {w.encode(): rng.randint(0, 3) for w in words}, (4, 5))
        block = {w.encode() for w in rng.sample(words, rng.randint(0, 12))}
        sets = {k: {w.encode() for w in t.split()} for k, t in templates.items()}
        assert index.matches(block) == {k: len(s & block) / len(s) for k, s in sets.items() if 5 * len(s & block) >= 4 * len(s)}


def plain_scores(rows, trained):
    words = [[*WORD.findall((t or "").translate(LOW)), " end"] for _, t in rows]
    one, two, three = (collections.Counter() for _ in range(3))
    for w, use in zip(words, trained):
        if use:
            one.update(w)
            two.update(zip(w, w[1:]))
            three.update(zip(w, w[1:], w[2:]))
    total = sum(one.values()) + len(one) + 1
    after = collections.defaultdict(lambda: [0, 0])
    for key, n in [*two.items(), *three.items()]:
        after[key[:-1]][0] += n
        after[key[:-1]][1] += 1

    def p(key):
        if len(key) == 1:
            return (one[key[0]] + 1) / total
        n, kinds = after[key[:-1]]
        held = (two if len(key) == 2 else three)[key]
        return (held + kinds * p(key[1:])) / (n + kinds) if kinds else p(key[1:])

    return [(len(w), sum(one[x] > 0 for x in w), sum(math.log10(p((x,))) for x in w),
             sum(math.log10(p(tuple(w[max(0, i - 2):i + 1]))) for i in range(len(w)))) for w in words]


@pytest.mark.parametrize("sizes", [(lm.RANGE_TOKENS, lm.NODES), (500, 300)])
def test_lm(spark, docs, nothing, sizes):
    use = [d is not None and d % 7 != 2 for d, _ in ROWS]
    trie = lm.train(docs.where("doc_id % 7 <> 2"), scratch(spark, "lm"), *sizes)
    got = sorted(((repr(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.score(docs, trie).collect()))
    expected = sorted((repr(d), *x) for (d, _), x in zip(ROWS, plain_scores(ROWS, use)))
    for a, b in zip(got, expected, strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * a[1] and abs(a[4] - b[4]) < 2e-3 * a[1]
    empty = lm.train(nothing, scratch(spark, "lm"))
    assert empty.tokens == 0 and lm.score(nothing, empty).collect() == []
    assert all(r.score == 0 for r in lm.score(docs, empty).collect())


def test_lm_looks_a_batch_up_at_once(spark, docs, monkeypatch):
    """op6: every slice of a megabyte, and every repeat of three words, went through all files of the model."""
    trie = lm.train(docs, scratch(spark, "lm"), 500, 300)
    texts = [t for _, t in ROWS if t]
    batch = pa.RecordBatch.from_pydict({"text": texts * 2})
    once = pa.Table.from_batches(lm._scored(trie, 0)([batch])).to_pylist()
    found, asked, find = [], [], lm.Level.find
    monkeypatch.setattr(lm.Level, "find", lambda level, parent, child: asked.append(len(parent)) or find(level, parent, child))
    monkeypatch.setattr(lm.Trie, "find_triples", lambda self, *x, whole=lm.Trie.find_triples: found.append(len(x[0])) or whole(self, *x))
    monkeypatch.setattr(lm, "slices", lambda column: words.slices(column, 100))
    assert pa.Table.from_batches(lm._scored(trie, 0)([batch])).to_pylist() == once
    single, all_asked = len(found), sum(asked)
    asked.clear()
    list(lm._scored(trie, 0)([pa.RecordBatch.from_pydict({"text": texts})]))
    assert single == 1 and all_asked <= sum(asked) + 10  # besides words that meet where the texts do
    monkeypatch.setattr(lm, "SCORE_TOKENS", 50)
    assert pa.Table.from_batches(lm._scored(trie, 0)([batch])).to_pylist() == once and len(found) > 5


def test_toxicity(spark, docs, nothing):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("bal", "dor", "fin", "gat") for b in "aeiouy"]
    rows, labels = [], []
    for d in range(400):
        own, bad = rng.choices(words, k=rng.randint(5, 60)), d % 4 == 0
        own += rng.choices(["vorgak", "Vοrgak", "v0rgaks", "ZIMPEL", "z1mpel"], k=3) if bad else []
        own += ["zimpeltown"] if not bad and d % 3 == 0 else []
        rng.shuffle(own)
        rows.append((d, " ".join(own)))
        labels.append((d, int(bad)))
    labels += [(None, 1), (7, None), (10**6, 1)]
    table, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(table, marks).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == (r.score >= 0.5) == (r.doc_id % 4 == 0) for r in got)
    odd = toxicity.toxicity(docs, marks).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd) and not any(r.predicted for r in odd)
    assert toxicity.toxicity(nothing, marks).collect() == []
    assert all(r.score < 1e-9 for r in toxicity.toxicity(docs, marks.limit(0)).collect())
    lexicon = toxicity.Lexicon({" vile ": 3.0}, ["vile bay"])
    assert lexicon.evidence(toxicity.folded("v1le")) == 3.0 and lexicon.evidence(toxicity.folded("near Vile Bay")) == 0


def test_toxicity_of_long_texts():
    """Evidence takes time with a text's length, and repeating a text scales its evidence as the formula says."""
    lexicon = toxicity.Lexicon({" vorg": 3.0, " zimp ": 2.0}, ["vorgan", "not zimp"])
    words = toxicity.folded("vorgaks v0rgaks zimp not zimp vorgan vorgans z1mp n0t z1mp clean ")
    one = lexicon.evidence(words)
    assert abs(one * math.sqrt(len(words)) - (3 + 3 + 2 + 3 + 2)) < 1e-9
    begun = time.monotonic()
    assert abs(lexicon.evidence(words * 10_000) / one - 100) < 1e-6
    assert time.monotonic() - begun < 20


def test_toxicity_of_disguised_words(spark):
    entries = {f" {w} ": 3.0 for w in ("loser", "clown", "worthless", "stupid", "scum", "imbecile", "asshole")} | {" ment": 2.0}
    lexicon = toxicity.Lexicon(entries, ["scum lake", "mentor"])
    for text in ("1oser", "c1own", "worth1ess", "$tupid", "$cum", "!mbec11e", "@$$hole", "5tup1d!!", "(c!own)", "lo$er!", "_$cum_"):
        assert lexicon.evidence(toxicity.folded(text)) == 3.0, text
    for text in ("100 $5 !!", "@$$", "scum 1ake", "$cum lake!", "mentor!!", "ment0r", "$tupidity", "2021"):
        assert lexicon.evidence(toxicity.folded(text)) == 0, text
    assert lexicon.evidence(toxicity.folded("$cum bay, mental!")) == 5.0 / math.sqrt(3)
    rng, words = random.Random(5), [f"{a}{b}" for a in ("bal", "dor", "fin", "gat") for b in "aeiouy"]
    rows = []
    for d in range(400):
        own = rng.choices(words, k=rng.randint(5, 60))
        own += rng.choices(["loser", "clown", "stupid"] if d % 8 else ["1oser", "c1own", "$tupid"], k=3) if d % 4 == 0 else ["good!"]
        rng.shuffle(own)
        rows.append((d, " ".join(own), int(d % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(table, table.where("doc_id % 8 <> 0").select("doc_id", "toxic")).collect()  # disguised ones unlabelled
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows, found = [tuple(r) for r in df.collect()], duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert list(map(repr, normal(rows, df.columns))) == list(map(repr, normal(found.fetchall(), columns)))


def test_token_queries(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    start = 0
    for r in QUERIES["op2_token_files"](spark, SF_DIR).orderBy("doc_id").collect():
        ids = own_ids(texts[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(raw(ids)))
        start += len(ids)
    packed = QUERIES["op1_packing"](spark, SF_DIR).collect()
    for r in packed:
        ids = own_ids(texts[r.doc_id], 2)
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(raw(ids[r.start:r.start + r.length]))
    assert sum(r.length for r in packed) == sum(len(own_ids(t, 2)) for t in texts.values())
    for r in QUERIES["op5_byte_pairs"](spark, SF_DIR).collect():
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_toxicity_on_held_out_labels(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op9_toxicity"](spark, sf_dir).join(labels, "doc_id").groupBy("held_out").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("right")
    ).collect()
    assert all(r.right > 0.95 for r in got)


def test_members_of_a_list_that_are_far_apart_make_no_rows(spark, monkeypatch):
    """Copies with four changed words each: any two share most of their sketches, few pairs reach the threshold."""
    rng, made = random.Random(11), []
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(150):
        words = list(base)
        for at in rng.sample(range(150), 4):
            words[at] = f"v{rng.randrange(40)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = near_dups._first_shared

    def counted(rows, rule):
        made.append(rows.count())
        return plain(rows, rule)

    monkeypatch.setattr(near_dups, "_first_shared", counted)
    rule = near_dups.Threshold(85, 100)
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs, rule).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(146)} for t in texts]
    parent = list(range(150))
    for a in range(150):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                ra, rb = next(iter_roots(parent, a)), next(iter_roots(parent, b))
                parent[max(ra, rb)] = min(ra, rb)
    assert got == {i: next(iter_roots(parent, i)) for i in range(150)}
    assert sum(made) < 150 * 20


def iter_roots(parent, at):
    while parent[at] != at:
        at = parent[at]
    yield at
