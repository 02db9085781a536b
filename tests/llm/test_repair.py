"""Conversation repair, decontamination and spelling variants against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.llm import conversation_repair as repair
from tagloom.llm import decontamination as leak
from tagloom.llm import queries, spelling
from tagloom.sources.tables import table

from ..conftest import SF_SMOKE
from .data import empty, messy

# ---- conversations ----------------------------------------------------------------------------------------------------

BLANK = re.compile(r"[^\x20\x09-\x0D]")
TURNS = "conv_id long, turn long, role string, text string, gone boolean, n long, c string, salt int, id long, digest string"


def fault_of(row, seen):
    solid = BLANK.findall(row[2])
    return ("blank" if not solid else "duplicate" if (row[1], row[2]) in seen
            else "truncated" if solid[-1] not in ".!?" else None)


def cheapest(rows, faults):
    """(cost, letters, repaired rows) by trying every edit, with all ties."""
    best = {"": (0, "", ())}  # role initials so far, folded to their state -> (cost, letters, rows)

    def add(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def wanted(state):
        return "assistant" if state == "u" else "user"

    def inserted(now):
        for _ in range(4):
            for state, (cost, letters, kept) in list(now.items()):
                role = wanted(state)
                add(now, role[0], (cost + 3, letters + "I", (*kept, f"{role}:")))
        return now
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, letters, kept) in inserted(dict(best)).items():
            add(after, state, (cost + 4, letters + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            late = 3 if fault else 0
            new = wanted(state)
            add(after, new[0], (cost + late + 3, letters + "R", (*kept, f"{new}:{text}")))
            if role[:1] == new[0] or (role[:1] == "s" and state == ""):
                add(after, role[:1], (cost + late, letters + "K", (*kept, f"{role}:{text}")))
        best = after
    return min(v for state, v in inserted(dict(best)).items() if state in ("", "a"))


def brute(rows):
    """Rows (turn, role, text) in order -> the report's columns."""
    seen, faults = set(), []
    for r in rows:
        faults.append(fault_of(r, seen))
        seen.add(r[1:])
    turns = {r[0] for r in rows} - {None}
    cost, letters, kept = cheapest(rows, faults)
    n = Counter(faults)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, letters,
            hashlib.sha256("\n".join(kept).encode()).hexdigest())


def ordered(rows):
    def key(r):
        return r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return sorted(rows, key=key)


def reported(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_query_equals_brute_force(spark):
    conversations, all_ids = {}, set()
    for conv, turn, role, text in table(spark, SF_SMOKE, "conversations").select("conv_id", "turn", "role", "text").collect():
        all_ids.add(conv)
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        conversations.setdefault(conv, []).extend([] if kind == 0 else [row, row] if kind == 3 else [row])
    want = {c: brute(ordered(rows)) for c, rows in conversations.items()}
    assert set(want) == all_ids
    got = reported(queries.conversation_repairs(spark, SF_SMOKE))
    assert got == want
    assert sum(v[5] > 0 for v in got.values()) > 5


def test_every_short_conversation_equals_a_search_over_edits():
    """All code strings up to four rows, against a search over all edit strings."""
    def search(codes):
        best = None
        for n_inserts in range(len(codes) + 3):
            for letters in itertools.product("DIKR", repeat=len(codes) + n_inserts):
                if letters.count("I") != n_inserts:
                    continue
                cost, state, i, ok = 0, "", 0, True
                for x in letters:
                    new = "a" if state == "u" else "u"
                    if x == "I":
                        cost, state = cost + 3, new
                        continue
                    code, i = codes[i], i + 1
                    if x == "D":
                        cost += 4
                    elif code == "x":
                        ok = False
                    else:
                        cost += 3 * code.isupper() + 3 * (x == "R")
                        kept = new if x == "R" else code.lower()
                        ok &= kept == new or (kept == "s" and state == "" and not set(letters[:letters.index(x)]) & set("IRK"))
                        state = kept
                    if not ok:
                        break
                if ok and state in ("", "a") and (best is None or (cost, "".join(letters)) < best):
                    best = (cost, "".join(letters))
        return best
    for n in range(4):
        for codes in itertools.product("xsuaoUA", repeat=n):
            assert repair.solve("".join(codes)) == search(codes), codes


def test_runs_combine_to_the_whole():
    rng = random.Random(5)
    for n in (1, 63, 64, 65, 200, 700):
        codes = "".join(rng.choices("xsuaoSUA", k=n))
        whole = repair.solve(codes)
        cut = sorted(rng.sample(range(n + 1), 2))
        parts = [codes[:cut[0]], codes[cut[0]:cut[1]], codes[cut[1]:]]
        solved = repair.weights(parts[0])
        for p in parts[1:]:
            solved = repair._then(solved, repair.weights(p))
        assert repair.decided(solved) == whole
        rows = [(i, {"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool"), "x" if c.isupper() else "x.")
                for i, c in enumerate(codes)]
        faults = ["blank" if c == "x" else "truncated" if c.isupper() else None for c in codes]
        assert cheapest(rows, faults)[:2] == whole


def test_odd_conversations_and_one_over_many_tasks(spark):
    rng = random.Random(3)
    rows = [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 0, None, None), (1, 9, "assistant", "Well!"),
            (None, 1, "user", "a?"), (None, 3, "assistant", "b." * 50_000), (3, None, None, None), (4, 2, "", "x."),
            (5, 1, "system", "s."), (6, 1, "user", "x"), (6, 1, "user", "y."), (7, 5, "Ünser", " \t\n")]
    rows += [(8, i // 2, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c!", f"{i}."])) for i in range(3000)]
    rows += [(9 + i, 0, "user", "Same first turn.") for i in range(300)]
    gone = [(900, 1, "user", "x.", True)]
    df = spark.createDataFrame([(*r, False, *[None] * 5) for r in rows] + [(*g, *[None] * 5) for g in gone], TURNS)
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = {c: brute(ordered(g)) for c, g in groups.items()} | {900: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = reported(repair.report(df, "gone"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == want
    texts = {}
    for r in repair.repaired(df, "gone").orderBy("conv_id", "place").collect():
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {
        c: v[-1] for c, v in want.items() if set(v[6]) - {"D"}}
    assert repair.plans(df.limit(0)).collect() == []
    assert repair.report(df.limit(0)).collect() == []


# ---- benchmark passages -----------------------------------------------------------------------------------------------

def leak_words(text):
    lower = (text or "").translate(str.maketrans(spelling.UPPER, spelling.LOWER))
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def leaks_of(text, items):
    words = leak_words(text)
    bare, hit, found = [w for w, _, _ in words], set(), set()
    for name, item in items:
        ws = [w for w, _, _ in leak_words(item)]
        n = min(10, len(ws))
        windows = {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if ws else set()
        for i in range(len(bare) - n + 1):
            if n and tuple(bare[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add("" if name is None else str(name))
    spans = []
    for i in sorted(hit):
        if i - 1 in hit:
            spans[-1][1] = words[i][2]
        else:
            spans.append([words[i][1], words[i][2]])
    return len(words), len(hit), sorted(found), [tuple(s) for s in spans]


PASSAGE = "Ärger mit 12 alten Schiffen, die NIE wieder aus dem Hafen fahren würden – sagte sie leise."


def leak_tables(spark):
    docs = messy(spark).select("doc_id", "text", "lang", "key", "doc", F.col("drop").alias("runs"), F.col("k").alias("items"))
    more = [(50, f"🙂 vorher. {PASSAGE} nachher 漢字"), (51, PASSAGE.upper().replace("Ä", "ä")), (51, PASSAGE), (52, "short item HERE"),
            (53, ("wort " * 60_000) + PASSAGE + (" ende" * 60_000)), (54, "x" * 3_000_000), (55, PASSAGE.rsplit(" ", 9)[0]),
            (None, PASSAGE + " " + PASSAGE), (56, "a short, item. here again short item here")]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    items = [(1, PASSAGE), (2, "short item here"), (3, None), (4, ".,!"), (None, " ".join(PASSAGE.split()[2:14])), (7, PASSAGE),
             (7, "something else"), (10, " ".join(f"w{i}" for i in range(5000)))]
    return docs, spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, segment string"), items


@pytest.mark.parametrize("part_words", [1_000_000, 300])
def test_leaks_equal_brute_force(spark, part_words):
    docs, bench, items = leak_tables(spark)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans])
                  for r in leak.scan(docs, bench, part_words).collect()), key=str)
    want = sorted(((r.doc_id, *leaks_of(r.text, items)) for r in docs.collect()), key=str)
    assert got == want
    assert sum(r[2] > 0 for r in got) >= 7


def test_cleaned_texts_have_no_leaks_and_clean_documents_stay(spark):
    docs, bench, items = leak_tables(spark)
    before = docs.collect()
    clean = sorted((r for r in before if not leaks_of(r.text, items)[1]), key=str)
    assert sorted(leak.cleaned(docs, bench, "documents").collect(), key=str) == clean
    left = leak.cleaned(docs, bench, "spans").collect()
    assert left[0].__fields__ == before[0].__fields__
    assert all(not leaks_of(r.text, items)[1] for r in left)
    assert sorted((r for r in left if r in clean), key=str) == clean
    assert 53 in {r.doc_id for r in left} and 51 not in {r.doc_id for r in left}
    long = "Ein Satz davor. " * 9
    one = spark.createDataFrame([(1, f"{long}🙂 {PASSAGE} Danach 漢字.")], "doc_id long, text string")
    assert leak.cleaned(one, bench).first().text == f"{long}🙂 . Danach 漢字."


def test_leaks_in_empty_tables(spark):
    docs, bench, _ = leak_tables(spark)
    assert leak.scan(empty(spark), bench).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in leak.scan(docs, bench.limit(0)).collect())


# ---- spellings --------------------------------------------------------------------------------------------------------

def variants_of(counts):
    letters = sorted({c for w in counts for c in w})
    near = {}
    for w in counts:
        around = {w[:i] + w[i + 1:] for i in range(len(w))}
        around |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        around |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = (around & set(counts)) - {w}
    best = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: b if b and counts[b] >= spelling.RATIO * counts[w] else None for w, b in best.items()}
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts.get(form[w]), root)
    return out


def found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_spelling_query_equals_brute_force(spark):
    counts = Counter()
    for doc_id, text in table(spark, SF_SMOKE, "documents").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    want = variants_of({w: n for w, n in counts.items() if n >= 5})
    assert found(queries.spellings(spark, SF_SMOKE)) == want
    assert sum(v[2] is not None for v in want.values()) > 5


def test_odd_words_equal_brute_force(spark):
    rng = random.Random(2)
    counts = {"".join(rng.choices("aab", k=rng.randint(6, 9))): rng.choice([5, 6, 25, 30, 150, 700, 5000]) for _ in range(250)}
    stem = "straße" * 20
    counts |= {**{"é" * (6 + i): 5 ** (i + 1) for i in range(5)}, "ÿÿÿÿÿÿ×": 7, "ÿÿÿÿÿÿ÷": 35,
               stem: 5, stem[:50] + stem[51:]: 40, stem + "x": 40, stem[:60] + "q" + stem[61:]: 40}
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, id string")
    got = found(spelling.variants(df))
    assert got == variants_of(counts)
    assert got["é" * 6][2] == "é" * 7 and got["é" * 6][4] == "é" * 10
    assert spelling.variants(df.limit(0)).collect() == []


def test_runs_of_odd_documents(spark):
    docs = spark.createDataFrame([(1, "Straßen-ÀÉÎÕÜ×÷x abcde"), (None, "abcdef"), (2, None), (3, ""), (4, "A" * 300_000)], "doc_id long, text string")
    got = {(r.doc_id, len(r.run), r.run[:12]) for r in spelling.runs(docs).collect()}
    assert got == {(1, 7, "straßen"), (1, 8, "ÀÉÎÕÜ×÷x"), (None, 6, "abcdef"), (4, 300_000, "a" * 12)}
    assert spelling.runs(empty(spark)).collect() == []
