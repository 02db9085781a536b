"""Near-dedup, language ID, packing, neighbours, secrets, token counts, pipeline."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import ann_forest, language_id, near_dedup, packing, secret_crf, shingles, token_count, tokenizing
from tagloom.llm.components import components
from tagloom.llm.queries import QUERIES, tokenizer_file

from ..conftest import SF_SMOKE
from .data import empty, messy, messy_rows

DOCS = "doc_id long, text string"


# ---- near-duplicates --------------------------------------------------------

def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def _jaccard_p(x, y):
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def _classes(items):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(items)), 2):
        if items[i] and items[j] and _jaccard_p(items[i], items[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(items))]


def test_similarity_is_probability_jaccard_and_signatures_estimate_it():
    random.seed(1)
    for _ in range(20):
        words = [random.choice("abcdefg") for _ in range(40)]
        other = [w if random.random() > 0.1 else "z" for w in words]
        texts = [" ".join(words), " ".join(other)]
        v = [np.unique(s, return_counts=True) for _, s in shingles.shingled(pa.array(texts))]
        want = _jaccard_p(*map(_shingles, texts))
        assert near_dedup.similarity(*v) == pytest.approx(want)
        est = np.mean([near_dedup.signature(v[0][0] ^ np.uint64(k), v[0][1]) == near_dedup.signature(v[1][0] ^ np.uint64(k), v[1][1])
                       for k in range(1, 9)])
        assert abs(est - want) < 0.12


def test_components_equal_union_find(spark):
    random.seed(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.get(i, i) != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    nodes = {x for p in pairs for x in p}
    assert {n: got.get(n, n) for n in nodes} == {n: find(n) for n in nodes}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)  # many blocks in small buckets
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [[random.choice(vocabulary) for _ in range(n)] for n in (3, 60, 120, 300, 300)]
    texts = []
    for b in base:
        texts += [" ".join(b), " ".join(b).upper()]
        for _ in range(30):  # copies around the level, in chains and apart
            c = list(b)
            for _ in range(random.randint(1, max(1, len(b) // 25))):
                c[random.randrange(len(c))] = random.choice(vocabulary)
            texts.append("  ".join(c))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " "), (903, "")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in near_dedup.classes(docs).collect()}
    want = dict(zip([i for i, _ in rows], [rows[r][0] for r in _classes([_shingles(t) for _, t in rows])]))
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = collections.Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got.values())
    kept = [r.doc_id for r in near_dedup.deduplicated(docs).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_near_duplicates_take_every_case(spark):
    got = near_dedup.classes(messy(spark)).collect()
    assert len(got) == len(messy_rows())
    cls = collections.defaultdict(set)
    for r in got:
        cls[r.doc_id].add(r.class_id)
    assert cls[1] == cls[2] == {1} and cls[None] == {None} and cls[3] == {3} and cls[4] == {4} and cls[5] == {5}
    out = near_dedup.deduplicated(messy(spark))
    assert out.columns == messy(spark).columns
    assert {r.doc_id for r in out.collect()} == {r[0] for r in messy_rows()} - {2, 9}
    assert near_dedup.classes(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\tÉé漢"))))
def test_words_of_batches_do_not_depend_on_the_batch(texts):
    together = [(w.tolist(), s.tolist()) for w, s in shingles.shingled(pa.array(texts, pa.string()))]
    alone = [next((w.tolist(), s.tolist()) for w, s in shingles.shingled(pa.array([t], pa.string()))) for t in texts]
    assert together == alone
    assert [len(w) for w, _ in together] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


# ---- language identification -------------------------------------------------

def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, SF_SMOKE).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "lang").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(i for i, r in got.items() if r.held_out) == sorted(held)
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_cases(spark):
    model = language_id.train(spark.read.parquet(f"{SF_SMOKE}/documents.parquet"))
    rows = language_id.identify(messy(spark), model).collect()
    assert len(rows) == len(messy_rows())
    for r in rows:
        if r.doc_id in (3, 4, 5):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in model.languages
    assert language_id.identify(empty(spark), language_id.train(empty(spark))).count() == 0
    nothing = language_id.fit([])
    assert nothing.predict("text") == ("und", 0.0, False) and model.predict("12 34 !") == ("und", 0.0, False)
    long = "una palabra de la lengua " * 60000
    assert model.logits(long) == pytest.approx(model.logits(long[:250000]), abs=0.05)


# ---- tokens ------------------------------------------------------------------

ALPHABET = "abÀéßÿ×÷'srtdlvem!.,AB09ªµ \n\t\x1d\x85　漢İςΣ1٢|<>_~🙂᠎​﻿́"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=30), st.sampled_from(["", "<|endoftext|>", "<|startoftext|>"]))
def test_tokens_equal_the_library(text, special):
    text = text[:9] + special + text[9:]
    counter = tokenizing.token_counter(tokenizing.read_definition(tokenizer_file("byte_bpe_50k.json")))
    ids = tokenizing.token_ids(tokenizing.read_definition(tokenizer_file("word_bpe_49k.json")))
    assert counter.count(text) == counter.whole(text)
    assert ids.ids(text).tobytes() == ids.whole(text)


def test_tables_of_pieces_turn_over(monkeypatch):
    monkeypatch.setattr(tokenizing, "MAX_PIECES", 3)
    ids = tokenizing.TokenIds(tokenizing.read_definition(tokenizer_file("word_bpe_49k.json")))
    text = " ".join(f"word{i % 11} x" for i in range(60))
    assert ids.ids(text).tobytes() == ids.whole(text) and len(ids.table) <= 4


def test_token_counts_and_cache(spark, tmp_path, monkeypatch):
    cache, path = str(tmp_path / "cache"), tokenizer_file("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = sorted(((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids))
                   for r in messy_rows()), key=str)
    for run in range(2):
        got = token_count.count_tokens(messy(spark), path, cache).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
        assert spark.read.parquet(cache).count() == len({r[1] or "" for r in messy_rows()}), run
    assert token_count.count_tokens(empty(spark), path, str(tmp_path / "none")).count() == 0


# ---- packing -----------------------------------------------------------------

def _check_packing(rows, docs, window):
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert zlib.crc32(np.array(r.input_ids, "<u4").tobytes()) == r.ids_crc32 and len(r.input_ids) == r.length > 0
    want = collections.Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in docs)
    got = collections.Counter()
    for i, pieces in by_doc.items():
        pieces = sorted(pieces, key=lambda r: (r.start, r.sequence_id, r.offset))
        n = sum(v for (j, _), v in want.items() if j == i)
        if n == 1:
            assert [r.start for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces[:-1])]
            got[i, tuple(x for r in pieces for x in r.input_ids)] += 1
            assert all(r.doc_tokens == sum(p.length for p in pieces) for r in pieces)
        else:
            assert sum(r.length for r in pieces) == sum(len(k[1]) * v for k, v in want.items() if k[0] == i)
    assert all(want[k] == v for k, v in got.items())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces[:-1])]
        total = sum(r.length for r in pieces)
        assert total == window or (total < window and total & (total - 1) == 0)


@pytest.mark.parametrize("shard,window", [(1000, 4096), (4, 64)])
def test_packing_is_an_exact_round_trip(spark, shard, window):
    docs = messy(spark)
    rows = packing.packed(docs, tokenizer_file("word_bpe_49k.json"), window, shard, with_ids=True).collect()
    _check_packing(rows, [r[:2] for r in messy_rows()], window)
    assert packing.packed(empty(spark), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_index_scores_are_bm25():
    docs = [np.array(d) for d in ([1, 2, 2], [2, 3], [4], [1, 5, 6, 2])]
    index, mean = packing.Index(docs), 2.5
    for seed in range(4):
        for j, d in enumerate(docs):
            want = 0.0
            for t in set(docs[seed].tolist()):
                df, tf = sum(t in x for x in docs), int((d == t).sum())
                want += np.log1p((4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean)) if tf else 0
            assert index.scores(seed)[j] == pytest.approx(want)


def test_neighbours_fill_the_window_of_their_seed():
    same = [np.array([1, 2, 3]), np.array([7, 8, 9]), np.array([1, 2, 4]), np.array([7, 8, 6])]
    assert packing.order(same, 6) == [0, 2, 1, 3]
    assert packing.sequence_lengths(15, 8) == [8, 4, 2, 1] and packing.sequence_lengths(0, 8) == []


def test_shards_know_all_documents_and_hold_lexical_neighbours(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(8 * 60)]
    texts = [" ".join(words[60 * topic + w] for w in rng.integers(0, 60, 80)) for topic in range(8) for _ in range(50)]
    rows = [(int(i), texts[j]) for i, j in enumerate(rng.permutation(len(texts)))]
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    ids = {i: np.array(library.encode(t, add_special_tokens=False).ids + [2]) for i, t in rows}
    encoded = spark.createDataFrame([(i, ids[i].astype("<u2").tobytes()) for i, _ in rows], "doc_id long, ids binary")
    dealt, corpus = packing.routed(encoded, 50, "<u2", 50000)
    assert corpus.mean == pytest.approx(np.mean([len(d) for d in ids.values()]))
    df = sum(int(ids[0][0]) in d for d in ids.values())
    assert corpus.idf[ids[0][0]] == pytest.approx(np.log1p((400 - df + 0.5) / (df + 0.5)))
    some = [ids[i] for i in range(20)]
    index = packing.Index(some, corpus)
    term = int(some[3][0])
    tf, norm = (some[3] == term).sum(), 1.2 * (0.25 + 0.75 * len(some[3]) / corpus.mean)
    at = np.searchsorted(index.vocabulary, term)
    mine = index.weight[index.start[at]:index.end[at]][index.doc[index.start[at]:index.end[at]] == 3]
    assert mine[0] == pytest.approx(corpus.idf[term] * tf * 2.2 / (tf + norm))
    shard = {r.doc_id: r.shard for r in dealt.select("doc_id", "shard").collect()}
    sizes = collections.Counter(shard.values())
    assert len(shard) == 400 and len(sizes) == 8 and max(sizes.values()) <= 75
    whole = packing.Index([ids[i] for i in range(400)])
    shared = []
    for seed in range(0, 400, 8):
        scores = whole.scores(seed)
        scores[seed] = -1
        shared += [shard[int(j)] == shard[seed] for j in np.argsort(-scores)[:10]]
    assert np.mean(shared) > 0.5  # dealt by a hash: one in eight


# ---- neighbours --------------------------------------------------------------

def _exact(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted(((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q))[:k]
            out[q] = [i for _, i in near]
    return out


def test_neighbours_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1))
    rows = [(i, x[i].tolist()) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann_forest.nearest(table, F.col("vec_id") % 20 == 0, sample=1024).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    want = _exact(rows, 20)
    assert got.keys() == want.keys() and all([r["rank"] for r in rs] == list(range(1, 21)) for rs in got.values())
    hits = sum(len({r.vec_id for r in got[q]} & set(w)) for q, w in want.items())
    assert hits >= 0.9 * 20 * len(want)
    assert all(r.score == pytest.approx(float(np.dot(x[r.query_id], x[r.vec_id])), abs=1e-12) for rs in got.values() for r in rs)


def test_neighbours_come_from_the_forest_alone(spark):
    x = np.random.default_rng(6).normal(size=(8000, 16))
    rows = [(i, x[i].tolist()) for i in range(8000)]
    table, ask = spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 400 == 0
    want = {q: set(np.argsort(-(x @ x[q]))[:21].tolist()) - {q} for q in range(0, 8000, 400)}

    def recall(**settings):
        got = collections.defaultdict(set)
        for r in ann_forest.nearest(table, ask, **settings).collect():
            got[r.query_id].add(r.vec_id)
        assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
        return np.mean([len(got[q] & set(sorted(w, key=lambda i: -(x[i] @ x[q]))[:20])) / 20 for q, w in want.items()])
    assert recall(sample=512) >= 0.9
    assert recall(sample=16384, share=0.004) < 0.7  # a scan of the sample would find all


def test_neighbours_cases(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(60)] + [(100, [3.0, 1.0]), (101, None), (102, []), (103, [0.0, 0.0]), (104, [1.0, None]),
                                             (105, [1.0, float("nan")]), (106, [float("inf"), 1.0]), (107, [1.0]), (None, same)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("leaf", F.lit(1))
    got = collections.defaultdict(list)
    for r in ann_forest.nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == _exact([(i, v) for i, v in rows if i is not None and i <= 100], 20)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r["rank"]) for r in ann_forest.nearest(few, F.col("vec_id") == 0).collect()] == [(1, 1), (2, 2)]
    assert ann_forest.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# ---- secrets -----------------------------------------------------------------

def _base_brute(text):
    out = []
    kinds = [("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
             ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
    for rank, (kind, pattern, group, least) in enumerate(kinds):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "api_key", "APIKEY", "token", "ſecret", "=", ": ", '"', "abc", "0123456789abcdef", "AKIA",
                                 "ABCDEFGH12345678", " ", "\n", "é", "漢", "hunter2"]), max_size=12))
def test_base_spans_equal_the_patterns(parts):
    text = "".join(parts)
    assert secret_crf.base_spans(text) == _base_brute(text)


@pytest.fixture(scope="module")
def field():
    random.seed(6)
    return secret_crf.fit([_note(i) for i in range(400)])


def _note(i):
    rng = random.Random(i)
    word = lambda: "".join(rng.choice("aeioutrns") for _ in range(rng.randint(2, 9)))
    value = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 40])))
    middle = rng.choice([f"password={value}", f'token = "{value}"', f"call {rng.randint(100, 999)}-{rng.randint(1000, 9999)}", "", ""])
    return " ".join([*(word() for _ in range(8)), middle, *(word() for _ in range(8))]) + "\n" + word()


def test_field_finds_held_out_secrets(field):
    hit = miss = wrong = 0
    for i in range(400, 700):
        text = _note(i)
        base, spans = secret_crf.base_spans(text), field.spans(text)
        hit += sum(any(a < e and s < b for a, b in spans) for s, _, _, e in base)
        miss += sum(not any(a < e and s < b for a, b in spans) for s, _, _, e in base)
        wrong += sum(not any(a < e and s < b for s, _, _, e in base) for a, b in spans)
    assert hit >= 0.95 * (hit + miss) and wrong <= 0.02 * hit


def test_viterbi_is_the_best_of_all_taggings(field):
    tokens, extra = ["the", "token", "=", "a1b2c3d4e5f6a7b8c9", "x"], [0.0, 0.0, 0.0]

    def score(tags):
        total, last = 0.0, secret_crf.OUTSIDE
        for i, t in enumerate(tags):
            total += field.moves[last][t] + field.emission(tokens, i, extra)[t]
            last = t
        return total
    best = max(itertools.product(range(3), repeat=len(tokens)), key=score)
    assert score(field.best(tokens, extra)) == pytest.approx(score(best))


def _decoded_everywhere(field, text):
    """Spans of a text with every line decoded as a chain."""
    extra, out, start = field._sum(secret_crf.file_features(text)), [], 0
    for line in text.split("\n"):
        found = list(secret_crf.TOKEN.finditer(line))
        for m, tag in zip(found, field.best([m[0] for m in found], extra)):
            if tag == secret_crf.BEGIN:
                out.append([start + m.start(), start + m.end()])
            elif tag == secret_crf.INSIDE:
                out[-1][1] = start + m.end()
        start += len(line) + 1
    return [tuple(s) for s in out]


def test_lines_of_plain_words_are_not_left_out():
    weights, moves = np.zeros((secret_crf.WEIGHTS, 3)), np.zeros((3, 3))
    moves[secret_crf.OUTSIDE, secret_crf.INSIDE] = secret_crf.NEVER
    weights[secret_crf.name_features(("passphrase", False))[1], secret_crf.BEGIN] = 9.0
    weights[secret_crf._bucket("plain"), secret_crf.OUTSIDE] = 4.0
    field = secret_crf.Field(weights, moves)
    text = "our passphrase correcthorse stays\nnothing here\n\npassphrase tiny"
    assert field.spans(text) == [(15, 27)] == _decoded_everywhere(field, text)


def test_bounds_leave_out_no_span(field):
    rng = random.Random(5)
    rough = secret_crf.Field(np.random.default_rng(3).normal(0, 1.2, (secret_crf.WEIGHTS, 3)) - [0.3, 0.2, 0], np.array(field.moves))
    words = ["password", "the", "pwd", "=", ":", '"', "abc123def456", "letters", "Bearer", "a", "é", "²", "x" * 30, "client_id", ">", "www.site.org/a"]
    texts = ["\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    for own in (field, rough):
        assert [own.spans(t) for t in texts] == [_decoded_everywhere(own, t) for t in texts]
    assert sum(len(rough.spans(t)) for t in texts) > 50


def test_added_spans_leave_base_spans(spark, field):
    base, every = secret_crf.scan_text(field, "my pin code = deadbeef0123456789 and password=abcdef0123456789ab\n")
    assert [s for s in every if s[2] != "crf"] == base and every == sorted(every)
    assert all(s[3] <= b[0] or b[3] <= s[0] for s in every if s[2] == "crf" for b in base)
    rows = secret_crf.scan(messy(spark), field).collect()
    assert len(rows) == len(messy_rows())
    blank = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == blank and r.spans == "" for r in rows if r.doc_id in (3, 4, 5))
    one = next(r for r in rows if r.doc_id == 12)
    assert (one.n_assign, one.n_access, one.n_hex) == (1, 1, 1)
    assert one.base_sha256 == hashlib.sha256(secret_crf.listed(_base_brute(messy_rows()[13][1])).encode()).hexdigest()
    assert secret_crf.scan(empty(spark), secret_crf.train(empty(spark))).count() == 0


# ---- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline as C
    docs = messy(spark).select("doc_id", "text", "lang", "source", "n_chars")
    seen = []
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        seen.append(sorted({r.doc_id for r in docs.collect()}, key=str))
    assert seen[0] == [1, 2, 6, None] and seen[1] == seen[0] and seen[2] == [1, 6, None]
    rows = C.STAGES[-1][1](spark, docs, "").collect()
    _check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], packing.WINDOW)
    nothing = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in C.STAGES:
        assert stage(spark, nothing, "").count() == 0
