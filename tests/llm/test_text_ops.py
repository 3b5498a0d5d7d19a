"""Operators on documents against brute force, over awkward rows."""

from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest

from pyspark.sql import functions as F_

from punctuo.llm import common, decontaminate, exact_dedup, line_dedup, packing, simhash, suffix_dedup, token_counts, toxicity

from . import cases

DOCS = cases.documents()


def rows_of(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# ---------------------------------------------------------------- 1

def test_column_bwt_is_the_sorted_suffixes():
    import random
    rng = random.Random(1)
    for _ in range(120):
        texts = [bytes(rng.choices(rng.choice([b"a", b"ab", b"abc"]), k=rng.randint(0, 12))) for _ in range(rng.randint(1, 7))]
        suffixes = sorted((t[j:], i, j) for i, t in enumerate(texts) for j in range(len(t) + 1))
        bwt, lcp = suffix_dedup.column_bwt(texts)
        assert bwt.tolist() == [texts[i][j - 1] + 1 if j else 0 for _, i, j in suffixes]
        common = [0]
        for (a, *_), (b, *_) in zip(suffixes, suffixes[1:]):
            common.append(next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b))))
        assert lcp.tolist() == common


@pytest.mark.parametrize("kw", [{}, {"held_bytes": 500, "collection_bytes": 2000}, {"hot_bytes": 300, "held_bytes": 900}])
def test_suffix_dedup(spark, kw):
    want = cases.removed(DOCS)
    got = suffix_dedup.suffix_dedup(cases.frame(spark, DOCS), with_text=True, **kw).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got} == want
    texts = dict(DOCS)
    for r in got:
        if r.kept is not None:
            b, at = cases.as_bytes(texts[r.doc_id]), 0
            parts = []
            for lo, hi in r.spans:
                parts.append(b[at:lo])
                at = hi
            assert bytes(r.kept) == b"".join(parts) + b[at:]


def test_suffix_dedup_of_a_passage_in_many_contexts_and_of_many_rows_without_id(spark):
    import random
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh ", k=170))
    noise = lambda: "".join(rng.choices("ijklmnop ", k=rng.randint(20, 90)))
    texts = [noise() + passage + noise() for _ in range(80)] + [noise() * 3 for _ in range(10)] + [passage[:120] * 2, passage[30:]]
    docs = list(enumerate(texts))
    want = cases.removed(docs)
    for kw in ({}, {"hot_bytes": 2000}, {"hot_bytes": 2000, "collection_bytes": 500, "held_bytes": 3000}):
        got = suffix_dedup.suffix_dedup(cases.frame(spark, docs), **kw).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got} == want
    some = [(None if i < 60 else i, t) for i, t in docs]
    one = suffix_dedup.suffix_dedup(cases.frame(spark, [(-1 if d is None else d, t) for d, t in some]))
    none = suffix_dedup.suffix_dedup(cases.frame(spark, some))
    shape = lambda df: Counter((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in df.collect())
    assert shape(none) == shape(one)


def test_suffix_dedup_ties_and_empty(spark):
    got = rows_of(suffix_dedup.suffix_dedup(cases.frame(spark, cases.TIES)), "doc_id", "n_bytes", "n_removed")
    # "same row " repeats itself from byte 9 on; null ids come first, so the copy under 9 goes whole
    assert got == Counter({(5, 270, 261): 2, (5, 260, 234): 1, (None, 240, 234): 2, (None, 0, 0): 1, (9, 240, 240): 1})
    assert suffix_dedup.suffix_dedup(cases.frame(spark, DOCS).limit(0)).count() == 0


# ---------------------------------------------------------------- 4

def test_token_counts_remember_words(monkeypatch):
    made, terminal = [], token_counts.SharedTrie.terminal
    monkeypatch.setattr(token_counts.SharedTrie, "terminal", lambda self, w: made.append(w) or terminal(self, w))
    words = [f"{i:x}" for i in range(20_000)]
    texts = [" ".join(words[at:at + 1000]) for at in range(0, 20_000, 1000)] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], names=["id", "text"])
    run = token_counts._counts(SimpleNamespace(value={"vocabulary": ({c: -1.0 for c in "0123456789abcdef"}, [-4.0] * 256)}))
    got = pa.Table.from_batches(run(iter([batch]))).to_pylist()
    assert len(made) == len(set(made)) == 20_000
    assert [x["n_tokens"] for x in got] == [sum(len(w) + 3 for w in t.split()) for t in texts]  # the mark is three bytes


def test_token_counts(spark):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.Unigram(*token_counts.vocabulary(path))
    want = Counter((d, len((t or "").split()), sum(model.count(token_counts.SPACE + w) for w in (t or "").split())) for d, t in DOCS)
    assert rows_of(token_counts.token_counts(cases.frame(spark, DOCS), path), "doc_id", "n_pretokens", "n_tokens") == want
    assert token_counts.token_counts(cases.frame(spark, cases.TIES), path).count() == len(cases.TIES)


def test_trie_counts_match_all_segmentations():
    pieces = {"a": -1.0, "b": -1.5, "ab": -2.2, "ba": -1.1, "aba": -2.9, "▁": -0.5}
    model = token_counts.Unigram(pieces, [-4.0] * 256)
    trie = token_counts.SharedTrie(model, nodes=25)

    def all_of(text):
        if not text:
            yield 0.0, 0
        for n in range(1, len(text) + 1):
            own = pieces.get(text[:n])
            if own is None and n == 1:
                own, many = -4.0 * len(text[0].encode()), len(text[0].encode())
            elif own is None:
                continue
            else:
                many = 1
            for s, k in all_of(text[n:]):
                yield s + own, k + many
    for text in ["", "a", "abab", "baab", "ababa", "▁éab", "bbbb", "abaaba"]:
        best = max(round(s, 9) for s, _ in all_of(text))
        assert trie.terminal(text) == model.count(text) == min(k for s, k in all_of(text) if round(s, 9) == best)


# ---------------------------------------------------------------- 5

ITEMS = [(1, cases.PASSAGE), (2, "one"), (3, None), (4, "..."), (2, "sit-amet"), (7, "Ωmega 日本語 nothing like it " * 4), (None, "one two")]


@pytest.mark.parametrize("limit", [decontaminate.PATTERN_CHARS, 300])
def test_decontaminate(spark, limit):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = cases.frame(spark, DOCS + [(900, "A one, b. " * 40), (901, "word " * 300 + " one")])
    got = decontaminate.decontaminate(docs, items, limit=limit).collect()
    want = cases.hits([(r.doc_id, r.text) for r in got], [(i, t) for i, t in ITEMS if i is not None])
    hit = {r[0]: r for r in want}
    for r in got:
        assert (r.n_words, r.contaminated) == (hit[r.doc_id][1], hit[r.doc_id][5])
        assert set(r.item_ids) <= {"1", "2", "4", "7"}
        for s in r.spans:
            assert r.text[s.start:s.stop].strip() == r.text[s.start:s.stop] != ""
    assert sum(r.n_hit for r in got) >= sum(r[2] for r in want) > 0
    empty = decontaminate.decontaminate(docs, items.limit(0))
    assert empty.filter("contaminated").count() == 0 and empty.count() == docs.count()
    assert decontaminate.clean(docs, items).columns == docs.columns


@pytest.mark.parametrize("limit", [decontaminate.PATTERN_CHARS, 300])
def test_decontaminate_equals_brute_force(spark, limit):
    items = [*ITEMS, (None, cases.PASSAGE), (3, "one two")]  # ids twice, none at all
    got = decontaminate.decontaminate(cases.frame(spark, DOCS, extra=False).withColumn("spans", F_.lit(1)),
                                      spark.createDataFrame(items, "item_id long, text string"), limit=limit)
    assert got.columns == ["doc_id", "text", *decontaminate.RESULTS]
    from pyspark.sql import functions as F
    assert rows_of(got.withColumn("d", F.sha2(F.array_join("item_ids", ","), 256)),
                   "doc_id", "n_words", "n_hit", "n_items", "d", "contaminated") == cases.hits(DOCS, items)


# ---------------------------------------------------------------- 6

@pytest.mark.parametrize("kw", [{}, {"digest": lambda c: bytes([len(c) % 3])}, {"held_bytes": 100, "salts": 2}])
def test_exact_dedup(spark, kw):
    import hashlib
    low = lambda t: cases.as_bytes(t).lower()
    keep, size = {}, Counter(low(t) for _, t in DOCS)
    for d, t in DOCS:
        keep[low(t)] = max(d, keep.get(low(t), d))
    want = Counter((d, keep[low(t)], size[low(t)], d == keep[low(t)], hashlib.sha256(low(t)).hexdigest()) for d, t in DOCS)
    got = exact_dedup.exact_dedup(cases.frame(spark, DOCS), **kw)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_exact_dedup_of_rows_that_repeat(spark):
    df = spark.range(0, 6000, 1, 6).selectExpr("CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS text").union(
        spark.range(0, 4000, 1, 4).selectExpr("9L AS doc_id", "'Same' AS text"))
    got = exact_dedup.exact_dedup(df).groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()
    assert {tuple(r) for r in got} == {(None, None, 6000, True, 1), (None, None, 6000, False, 5999), (9, 9, 4000, True, 1), (9, 9, 4000, False, 3999)}


def test_exact_dedup_ties_and_survivors(spark):
    ties = cases.frame(spark, cases.TIES)
    got = rows_of(exact_dedup.exact_dedup(ties), "doc_id", "keep_id", "group_size", "kept")
    assert got == Counter({(5, 5, 2, True): 1, (5, 5, 2, False): 1, (5, 5, 1, True): 1, (None, 9, 3, False): 2,
                           (9, 9, 3, True): 1, (None, None, 1, True): 1})
    left = exact_dedup.survivors(ties)
    assert left.columns == ties.columns
    assert rows_of(left, "doc_id", "text") == Counter({cases.TIES[0]: 1, cases.TIES[2]: 1, (None, None): 1, cases.TIES[6]: 1})
    assert exact_dedup.exact_dedup(ties.limit(0)).count() == 0


# ---------------------------------------------------------------- 7

def test_encoder_equals_the_library():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t, encode = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read())
    odd = ["Ça va? It's THE İstanbul ΣΑΣ é x<|endoftext|>y don't a\x1cb   ½ 12³ 中文 <|x ﬁ", "", " \n", "'S'LL 'd", None]
    for text in [*odd, *(t for _, t in DOCS)]:
        text = text or ""
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_known_forgets_without_loss():
    known = packing.Known(6)
    for i in range(40):
        for k in known.missing({str(i), str(i // 2)}):
            known[k] = k.encode()
        assert known[str(i)] == str(i).encode() and known[str(i // 2)] == str(i // 2).encode()


def test_encoder_looks_known_words_up_once(monkeypatch):
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encode = packing.Encoder(f.read())
    first = encode("the cat, the dog")
    asked, missing = [], encode.words.missing
    monkeypatch.setattr(encode.words, "missing", lambda keys: asked.append(sorted(keys)) or missing(keys))
    assert encode("the cat, the dog") == first and asked == []
    assert encode("the cat, the cow cow") == encode._whole("the cat, the cow cow") and asked == [["cow"]]


def test_encoder_that_forgets_within_a_text_equals_the_library(monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3000)
    monkeypatch.setattr(packing, "KNOWN_PARTS", 1500)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encode = packing.Encoder(f.read())
    for text in [t or "" for _, t in DOCS] * 2:
        ids = encode(text)
        assert ids == encode._whole(text)
    words = [f"w{i % 37}x" for i in range(500)]
    for at in range(0, 500, 7):
        text = " ".join(words[at:at + 20])
        assert encode(text) == encode._whole(text)


def test_packing(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    docs = DOCS + cases.TIES
    got = packing.pack(cases.frame(spark, docs), path, capacity=512).collect()
    want = Counter()
    for d, x in docs:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 512):
            part = np.array(ids[k:k + 512], "<u4")
            want[d, k // 512, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    least = -(-sum(r.length for r in got) // 512)
    assert len(by) <= least + 1
    assert packing.pack(cases.frame(spark, docs).limit(0), path).count() == 0


def test_plan_covers_the_histogram():
    import random
    rng = random.Random(5)
    for histogram in [{4096: 3}, {1: 5}, {3000: 7, 2000: 4}, {rng.randint(1, 4096): rng.randint(1, 500) for _ in range(400)},
                      {rng.randint(2100, 4096): 50 for _ in range(60)}]:
        got, plan = Counter(), packing.plan(histogram)
        for config, n in plan:
            assert sum(s * k for s, k in config) <= 4096 and n > 0
            for s, k in config:
                got[s] += k * n
        assert got == histogram
        used = sum(n for _, n in plan)
        fit = sum(n for _, n in packing.best_fit(histogram, 4096))
        assert used <= fit * 1.01 + 2


def test_weights_close_the_gap_at_every_size():
    import random

    import numpy as np
    rng = random.Random(11)
    wide = {n: rng.randint(1, 300) for n in range(600, 1500)}
    for histogram in [{2066: 6000, 1063: 6000, 1043: 6000, 983: 12000}, {rng.randint(500, 2200): rng.randint(500, 9000) for _ in range(20)},
                      {rng.randint(1, 4096): rng.randint(1, 500) for _ in range(450)}, wide]:
        lengths = np.array(sorted(histogram))
        need = np.array([histogram[int(x)] for x in lengths], float)
        solution, value, bound = packing.fractional(lengths, need, 4096)
        assert sum(n for _, n in solution) <= value + 1 and bound <= value <= bound * (1 + packing.GAP)
        covered = Counter()
        for config, n in solution:
            assert sum(s * k for s, k in config) <= 4096
            for s, k in config:
                covered[s] += k * n
        assert all(covered[s] >= n - 0.01 * max(1, n) for s, n in histogram.items())
    sequences = lambda p: sum(n for _, n in p)
    assert sequences(packing.plan(wide)) < 0.995 * sequences(packing.best_fit(wide, 4096))


def test_plan_without_exact_fillings():
    import random
    sequences = lambda p: sum(n for _, n in p)
    assert sequences(packing.plan({2066: 6000, 1063: 6000, 1043: 6000, 983: 12000})) == 9000  # 4092 of 4096 each
    rng = random.Random(8)
    hot = {rng.randint(300, 2500): rng.randint(1, 40) for _ in range(60)}
    hot[1400] = 2 * sum(hot.values())
    few = [{rng.randint(500, 2200): rng.randint(500, 9000) for _ in range(k)} for k in (2, 3, 5, 8, 20)]
    for histogram in [hot, *few, {rng.randint(1, 4096): rng.randint(1, 500) for _ in range(600)}]:
        plan, got = packing.plan(histogram), Counter()
        for config, n in plan:
            assert sum(s * k for s, k in config) <= 4096 and n > 0
            for s, k in config:
                got[s] += k * n
        assert got == histogram and sequences(plan) <= sequences(packing.best_fit(histogram, 4096))


# ---------------------------------------------------------------- 8

@pytest.mark.parametrize("rows", [DOCS, cases.TIES])
def test_simhash(spark, rows):
    assert rows_of(simhash.simhash_dedup(cases.frame(spark, rows)), "doc_id", "fingerprint", "component_id") == cases.simhashes(rows)


def test_gray_index_and_groups(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = np.unique(np.concatenate([s ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) ^
                                    (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) for s in seeds]))
    index = simhash.GrayIndex(fps)
    q, at = index.search(fps, 2)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    assert set(zip(q.tolist(), index.order[at].tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    low = simhash.smallest_linked(len(fps), *np.nonzero(near))
    for group, nodes in ((simhash.GROUP, simhash.NODES), (20, simhash.NODES), (1, 50)):
        edges = simhash.links(df, 2, group, nodes)
        assert group < simhash.GROUP or edges.count() < 2 * len(fps)  # not all pairs
        root = {r.a: r.b for r in simhash.components(edges).collect()}
        of = {}
        for i, x in enumerate(fps.view(np.int64).tolist()):
            assert of.setdefault(root.get(x, x), low[i]) == low[i]
        assert len(of) == len(set(low.tolist()))


def test_components_of_few_links_take_few_rounds(spark, monkeypatch):
    import numpy as np
    written = []
    monkeypatch.setattr(simhash, "written", lambda df, name: written.append(name) or common.written(df, name))
    order = np.random.default_rng(3).permutation(300).tolist()
    rows = [*zip(order[:199], order[1:200]), *zip(order[200:299], order[201:300]), (order[5], order[0]), (order[7], order[7])]  # two chains
    edges = spark.createDataFrame(rows, "a long, b long").repartition(3)
    low = {x: min(part) for part in (order[:200], order[200:]) for x in part}
    want = sorted((x, m) for x, m in low.items() if x != m)
    assert sorted((r.a, r.b) for r in simhash.components(edges).collect()) == want
    assert len(written) <= 3
    monkeypatch.setattr(simhash, "LINKS", 40)  # links in several files, and looked at a few at a time
    assert sorted((r.a, r.b) for r in simhash.components(edges).collect()) == want
    assert simhash.components(edges.limit(0)).collect() == []


def test_written_tables_are_read_without_a_job(spark):
    spark.sparkContext.setJobGroup("written", "")
    df = common.written(spark.range(5, numPartitions=1), "five")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("written")) == 1  # the writing
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4]
    assert common.written(spark.range(5).limit(0), "none").columns == ["id"]


def test_near_survivors(spark):
    rows = DOCS + cases.TIES
    df = cases.frame(spark, rows)
    left = simhash.near_survivors(df)
    assert left.columns == df.columns
    components = {(c[1], c[2]) for c in cases.simhashes(rows)}
    fps = {c[1]: c[2] for c in cases.simhashes(rows)}
    assert left.count() <= len(components)
    assert {r.doc_id for r in left.collect()} == set(fps.values())
    assert simhash.near_survivors(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 9

def line_brute(docs):
    """By document: (lines removed, multi-line chunks, kept text) by the chunkings, matches grown line by line."""
    import xxhash
    lines = {d: (t or "").split("\n") for d, t in docs}
    chunks = {}
    for d, of in lines.items():
        h, chunks[d] = [xxhash.xxh64_intdigest(x.encode(), 42) for x in of], set()
        for byte, turned, open_, close in [(b, t, 128, 128) for b in line_dedup.FINE for t in (False, True)] + [
                (b, False, *x) for b, *x in line_dedup.COARSE]:
            e = [(255 - (x >> 8 * byte & 255)) if turned else x >> 8 * byte & 255 for x in h]
            start = 0
            for i in range(len(e)):
                if i + 1 == len(e) or not (e[i] < open_ and e[i + 1] >= close):
                    chunks[d] |= {(start, i + 1 - start)} if i > start else set()
                    start = i + 1
        start = 0
        for i in range(len(of)):
            if i + 1 == len(of) or of[i] != of[i + 1]:
                chunks[d] |= {(j, 2) for j in range(start, i, 2)}
                start = i + 1

    def again(of):
        places = {}
        for d, found in of.items():
            for s, n in found:
                places.setdefault(tuple(lines[d][s:s + n]), []).append((d, s, n))
        return {p: p == min(x) for x in places.values() if len(x) > 1 for p in x}

    known, others = again(chunks), {}
    for d, of in lines.items():
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in of]
        others[d] = {(i, 2) for i in range(len(h) - 1) if not any((h[i] ^ h[i + 1]) >> 8 * b + 7 & 1 for b in line_dedup.FINE)}
    runs = again(others)
    met = {(d, j, 2) for d, s, n in known for j in (s - 1, s + n - 1)} & set(runs)
    while more := {(d, j, 2) for d, s, _ in met for j in (s - 1, s + 1)} & set(runs) - met:
        met |= more
    for p in met:
        known[p] = known.get(p, True) and runs[p]
    out = {}
    for d, of in lines.items():
        gone = {i for (e, s, n), first in known.items() if e == d and not first for i in range(s, s + n)}
        out[d] = (len(gone), len(chunks[d]), "\n".join(x for i, x in enumerate(of) if i not in gone))
    return out


def test_line_dedup_deals_out_repeats_only(spark, monkeypatch):
    read, write = {}, line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: read.setdefault(name, df.inputFiles()) and None or write(df, name))
    docs = [(1, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (3, "x\ny\nz"), (4, None)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(cases.frame(spark, docs)).collect()}
    assert not any("line-chunks" in f for f in read["line-texts"])
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed, got[4].n_removed) == (0, 4, 0, 0)
    assert got[1].n_chunks == got[2].n_chunks > 0 and got[4].n_chunks == 0


def test_line_dedup(spark):
    shared = "\n".join(f"license line {i} of the notice" for i in range(30))
    docs = DOCS + [(500 + i, f"own {i}\n" * (i + 1) + shared + f"\ntail {i}") for i in range(8)]
    want = line_brute(docs)
    got = line_dedup.line_dedup(cases.frame(spark, docs))
    assert {r.doc_id: (r.n_removed, r.n_chunks, r.kept_text) for r in got.collect()} == want
    assert sum(w[0] for w in want.values()) > 200
    ties = line_dedup.line_dedup(cases.frame(spark, [(1, "a\nb\nc\nd\ne\nf\ng")] * 2 + cases.TIES))
    assert ties.count() == 2 + len(cases.TIES) and {r.n_removed for r in ties.filter("doc_id = 1").collect()} == {0}
    nulls = line_dedup.line_dedup(cases.frame(spark, [(1, "a\nb\nc\nd")] * 2 + [(None, "a\nb\nq"), (None, "a\nb\nq"), (None, None)]))
    assert Counter((r.doc_id, r.n_removed, r.kept_text) for r in nulls.collect()) == {
        (1, 2, "c\nd"): 2, (None, 0, "a\nb\nq"): 2, (None, 0, ""): 1}
    assert line_dedup.line_dedup(cases.frame(spark, docs).limit(0)).count() == 0
    assert "PythonUDF" not in (plan := got._jdf.queryExecution().toString()) and "InPandas" not in plan and "InArrow" not in plan


def runs_brute(docs, least=2):
    """By document: (lines removed, sha256 of the text kept) when every repeated run of lines goes but the first."""
    import hashlib
    seen, out = set(), {}
    for d, t in sorted(set(docs), key=lambda r: r[0]):
        lines = (t or "").split("\n")
        gone = set()
        for i in range(len(lines) - least + 1):
            run = tuple(lines[i:i + least])
            gone.update(range(i, i + least) if run in seen else ())
            seen.add(run)
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[d] = (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_line_dedup_finds_repeated_runs(spark, tmp_path):
    own = lambda d, n: "\n".join(f"own line {d} {i} {d * 31 + i * 17}" for i in range(n))
    docs = list(DOCS)
    for k in range(2, 9):  # passages of k lines among other lines, twice each
        for m in range(40):
            passage = "\n".join(f"passage {k} {m} line {i}" for i in range(k))
            docs += [(1000 * k + 2 * m + j, f"{own(1000 * k + 2 * m + j, 1 + j)}\n{passage}\n{own(9000 + 1000 * k + 2 * m + j, 2)}")
                     for j in range(2)]
    docs += [(20_000, "same\nsame\nsame\nother"), (20_001, "x\n\n\ny"), (20_002, "z\n\n\n")]
    cases.frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = line_dedup.op9_line_dedup(spark, str(tmp_path)).collect()
    want = runs_brute(docs)
    assert len(got) == len(docs) and all(r.n_removed <= want[r.doc_id][0] for r in got)
    assert all(r.kept_sha256 == want[r.doc_id][1] for r in got if r.n_removed == want[r.doc_id][0])
    removed = {r.doc_id: r.n_removed for r in got}
    assert sum(removed.values()) >= 0.95 * sum(n for n, _ in want.values())
    for k in range(2, 9):  # whole passages, by their length
        caught = sum(removed[1000 * k + 2 * m + 1] >= k for m in range(40))
        assert caught >= (34 if k == 2 else 39)


# ---------------------------------------------------------------- 10

def toxic_docs(n=600):
    import random
    rng = random.Random(4)
    words = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        w = rng.choices(words, k=rng.randint(5, 80))
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grumblefrotz", "vilewort", "scumbrel"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_learns_and_scores_all(spark):
    docs, labels = toxic_docs()
    odd = [(10_000, None), (10_001, ""), (None, "vilewort grumblefrotz vilewort scumbrel"), (10_002, "plain " * 40_000)]
    lab = spark.createDataFrame(labels + [(10_003, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(cases.frame(spark, docs + odd), lab).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {d: y for d, _, y in labels}
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == cases.held_out(r.doc_id) for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.95
    # labels of the held-out fold change nothing
    flipped = [(d, q, 1 - y if cases.held_out(d) else y) for d, q, y in labels]
    again = toxicity.toxicity(cases.frame(spark, docs), spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    scores = {r.doc_id: r.score for r in got if r.doc_id is not None and r.doc_id < 10_000}
    assert all(abs(r.score - scores[r.doc_id]) < 1e-9 for r in again.collect())


def test_toxicity_against_plain_python(spark):
    """Features, log-count ratios and scores worked out again letter by letter; copies of an id train once."""
    import math
    import zlib

    import numpy as np

    def places(text):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in f" {text or ''} ")
        out = set()
        for n in (3, 4, 5):
            for i in range(len(t) - n + 1):
                h = 0
                for c in t[i:i + n]:
                    h = (h * 16_777_619 + ord(c)) % 2 ** 32
                out.add(((h ^ h >> 15 ^ n * 0x9E3779B1 % 2 ** 32) * 0x85EBCA6B % 2 ** 32) >> 14)
        return out

    docs, labels = toxic_docs(150)
    docs += [(d, "日本語のテキスト VILEWORT été" * 3) for d in (5, 700)]
    for _, t in [*docs, (0, None), (0, ""), (0, "É日a")]:
        assert set(toxicity.features(t, toxicity.new_board()).tolist()) == places(t)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = cases.frame(spark, docs + docs[:40] + docs[:40])
    weights, intercept, learnt = toxicity.train(df, lab)
    truth = {d: y for d, _, y in labels if zlib.crc32(str(d).encode()) % 5}
    rows = [(places(t), truth[d]) for d, t in docs[:150] if d in truth and d != 5]
    p, q = Counter(x for r, y in rows if y for x in r), Counter(x for r, y in rows if not y for x in r)
    got = toxicity.log_count_ratios([np.array(sorted(r), np.int32) for r, _ in rows], np.array([y for _, y in rows]), 1 << 18)
    for x in list(p)[:300] + list(q)[:300]:
        want = math.log((p[x] + 1) / (sum(p.values()) + 2 ** 18)) - math.log((q[x] + 1) / (sum(q.values()) + 2 ** 18))
        assert abs(got[x] - want) < 1e-9
    assert learnt
    for r in toxicity.toxicity(df, lab).collect():
        options = []
        for d, t in docs:
            if d == r.doc_id:
                f = places(t)
                z = intercept + sum(float(weights[x]) for x in f) / math.sqrt(len(f)) if f else intercept
                options.append(1 / (1 + math.exp(-z)))
        assert min(abs(r.score - o) for o in options) < 1e-5


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(cases.frame(spark, cases.TIES), none)
    assert {round(r.score, 3) for r in got.collect()} == {0.5}
    df = cases.frame(spark, DOCS)
    assert toxicity.decent(df, none).columns == df.columns
    assert toxicity.toxicity(df.limit(0), none).count() == 0


def test_decent_keeps_all_rows_where_nothing_was_learnt(spark):
    kind = "doc_id long, quality int, toxic int"
    docs = DOCS + cases.TIES
    df, ids = cases.frame(spark, docs), [d for d, _ in DOCS]
    for rows in ([], [(d, 1, None) for d in ids], [(d, 1, d % 2) for d in ids if cases.held_out(d)], [(d, 1, 1) for d in ids]):
        kept = toxicity.decent(df, spark.createDataFrame(rows, kind))
        assert kept.columns == df.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(docs)
    docs, labels = toxic_docs(200)
    kept = toxicity.decent(cases.frame(spark, docs), spark.createDataFrame(labels, kind)).count()
    assert 0 < kept < len(docs)  # and drops rows where there was something to learn
