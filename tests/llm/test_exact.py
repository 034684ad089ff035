"""Operators against brute force on the smallest tables, round trips and held-out labels."""

import collections
import hashlib
import random
import struct
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tickloom.llm import common, decontam, mixing, neardup, qualityforest, radixdedup, records, sentencespans, toxicity
from tickloom.llm.queries import tokenizer_path

from .cases import SF, passage


@pytest.fixture(scope="module")
def docs():
    t = pq.read_table(f"{SF}/documents.parquet")
    return sorted(zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist(), strict=True))


def result(spark, name, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in entry.queries()[name](spark, SF).collect()}


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel, df = con.sql(entry.oracle_sql()[name]), entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    assert sorted(map(repr, map(tuple, df.select(cols).collect()))) == sorted(map(repr, rel.project(", ".join(cols)).fetchall()))


def test_mix_comes_near_its_targets(spark):
    big = spark.range(30000).selectExpr("id as doc_id", "repeat('w ', cast(10 + id % 7 as int)) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 9) end as source")
    rows = mixing.taken_words(big)
    again = mixing.taken_words(big.repartition(7))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, again.collect()))
    taken, target, size = collections.Counter(), {}, {}
    src = {r.doc_id: r.source for r in big.select("doc_id", "source").collect()}
    for r in rows.collect():
        assert r.taken <= 2 * r.size
        taken[src[r.doc_id]] += r.taken
        target[src[r.doc_id]], size[src[r.doc_id]] = r.target, r.source_size
    assert all(abs(taken[s] - t) < 0.05 * t for s, t in target.items())
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert mixing.mix_sources(big).count() == rows.agg({"copies": "sum"}).first()[0]


def test_caps_are_filled_first(spark):
    docs = spark.createDataFrame([(1, "a " * 10, "a"), (2, "a " * 1000, "b"), (3, "a " * 100, "c"), (4, "", "d"), (5, "a " * 50, None)], "doc_id long, text string, source string")
    got = {r.doc_id: r.target for r in mixing.taken_words(docs).collect()}
    # weights 3 1 2 3 1; the small ones stop at twice their size
    assert got == {1: 20.0, 2: pytest.approx(1740 - 20 - 200 - 100), 3: 200.0, 4: 0.0, 5: 100.0}


def test_records(spark, docs):
    from tokenizers import Tokenizer

    t, start, want = Tokenizer.from_file(tokenizer_path()), 0, {}
    for i, text in docs:
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert result(spark, "op2_token_records", "start", "n_tokens", "ids_crc32") == want


def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer

    r, t = random.Random(5), Tokenizer.from_file(tokenizer_path())
    encode = records.PieceEncoder(tokenizer_path(), True, "<u2")
    alphabet = "aZé ñß.,!?'\n\t 12<|>*#$%&İıſ\u0301\u00a0\u2028😀-_@"
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 30)))
        assert np.frombuffer(encode(text), "<u2").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
    assert encode("it's <|endoftext|> don't") == encode.whole("it's <|endoftext|> don't")


def test_other_tokenizers_are_not_cut():
    assert records.splits_at_spaces(tokenizer_path()) and not records.splits_at_spaces(tokenizer_path("byte_bpe_50k.json"))


def test_broken_records_are_noticed(spark, tmp_path):
    data = records.frame(b"one") + records.frame(b"") + records.frame(b"three")
    at, out = 0, []
    while at < len(data):
        payload, at = records.unframe(data, at)
        out.append(payload)
    assert out == [b"one", b"", b"three"]
    for i in (0, 9, 13, len(data) - 1):
        with pytest.raises(ValueError):
            at, bad = 0, bytearray(data)
            bad[i] ^= 1
            while at < len(bad):
                _, at = records.unframe(bytes(bad), at)
    docs = spark.createDataFrame([(2, "b b"), (1, "a"), (3, None)], "doc_id long, text string")
    index = records.write_records(docs, str(tmp_path / "r"), tokenizer_path())
    shuffled = index.orderBy("bytes", ascending=False)
    assert {r.doc_id: r.ids[-1] for r in records.read_records(shuffled, str(tmp_path / "r")).collect()} == {1: 1, 2: 1, 3: 1}


def components(sets):
    inv, shared = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for h in s:
            inv[h].append(i)
    for own in inv.values():
        for a in range(len(own)):
            for b in range(a):
                shared[own[b], own[a]] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in shared.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in sets}


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_duplicates(spark, docs):
    sets = {i: shingle_set(t) for i, t in docs}
    comp = components(sets)
    assert result(spark, "op4_minhash_near_dedup", "n_shingles", "component_id", "kept") == {i: (len(s), comp[i], comp[i] == i) for i, s in sets.items()}


def test_large_group_of_near_copies(spark):
    """Copies of one text with edits, so that many pairs are just above and below the threshold, and chains form."""
    r, base = random.Random(9), passage(20, 200).split()
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(r.randint(0, 9)):
            words[r.randrange(len(words))] = passage(1000 + i, 1)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, passage(30 + i, 40)) for i in range(50)]
    sets = {i: shingle_set(t) for i, t in rows}
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == components(sets)


def test_pairs_just_above_the_threshold(spark):
    """2,000 pairs with similarities from 0.75 to 0.80: all are linked."""
    r, rows, similar = random.Random(21), [], []
    for i in range(2000):
        words = [f"w{r.randrange(10**9)}" for _ in range(r.randint(60, 160))]
        n = len(words) - 4
        # words changed at the end: each costs one shingle of each side
        k = int((n - 0.775 * n) / 1.775 + r.uniform(-0.02, 0.02) * n)
        other = words[: len(words) - k] + [f"v{r.randrange(10**9)}" for _ in range(k)]
        share = len(shingle_set(" ".join(words)) & shingle_set(" ".join(other))) / len(shingle_set(" ".join(words)) | shingle_set(" ".join(other)))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        similar.append(share)
    assert sum(0.75 <= x <= 0.80 for x in similar) > 1200
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((got[2 * i + 1] == 2 * i) == (100 * x >= 75 - 1e-9) for i, x in enumerate(similar))


def test_rows_without_or_with_the_same_id_are_judged_alone(spark):
    a, b, c = passage(60, 120), passage(61, 120), passage(62, 120)
    rows = [(None, a), (None, b), (None, b), (5, c), (5, passage(63, 120)), (5, c), (6, c.replace("ba", "bo", 1)), (None, None), (None, None), (7, "")]
    out = neardup.drop_near_duplicates(spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")).collect()
    assert sorted(str((r.doc_id, r.text)) for r in out) == sorted(map(str, [(None, a), (None, b), (5, c), (5, passage(63, 120)), (None, None), (None, None), (7, "")]))


def test_radix_against_all_windows(spark, docs):
    extra = [(10_000, docs[0][1][:5000] + passage(2, 400) + docs[0][1][100:700]), (10_001, "ab" * 400), (10_002, passage(2, 400)[7:900] + "é" * 150), (10_003, "x" * 199), (10_004, "x" * 200)]
    rows = docs[:120] + extra
    count, data = collections.Counter(), {i: (t or "").encode() for i, t in rows}
    for b in data.values():
        count.update(b[p : p + 200] for p in range(len(b) - 199))
    want = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if count[b[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        runs = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        want[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cols = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    for most in (radixdedup.IN_TASK, 1):  # in tasks, and by the shuffle
        before, radixdedup.IN_TASK = radixdedup.IN_TASK, most
        try:
            assert {r.doc_id: tuple(r[c] for c in cols) for r in radixdedup.remove_repeats(df).collect()} == want
        finally:
            radixdedup.IN_TASK = before


def test_base_statistics(docs):
    for _, text in docs:
        words = text.encode().split()
        n = len(words)
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(n - 2))
        repeat = sum(any(windows[tuple(words[j : j + 3])] > 1 for j in range(max(0, i - 2), min(i, n - 3) + 1)) for i in range(n)) if n > 2 else 0
        lines, seen, dup = text.split("\n"), set(), 0
        for x in lines:
            if x.encode().split():
                dup += x in seen
                seen.add(x)
        want = (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, repeat)
        assert qualityforest.statistics(text)[0] == want


def test_quality_keeps_the_good(spark):
    t = pq.read_table("/root/testdata/sf0.01/labels.parquet")
    quality = dict(zip(t.column("doc_id").to_pylist(), t.column("quality").to_pylist(), strict=True))
    rows = [r for r in entry.queries()["op7_quality_forest"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in quality and not r.base_failed]
    good, bad = [r.kept for r in rows if quality[r.doc_id]], [r.kept for r in rows if not quality[r.doc_id]]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_kept_against_brute_force(spark):
    """Paths walked row by row through the trees, and the best of all thresholds tried one by one."""
    docs, marks = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = common.durable(qualityforest.rule_statistics(docs), "t")
    forest = qualityforest.fit_forest(stats)
    rows = {r.doc_id: np.array(r.features, np.float32) for r in stats.collect()}
    anomaly = {}
    for i, x in rows.items():
        total = 0.0
        for feature, split, left, right, depth in forest.trees:
            at = 0
            while feature[at] >= 0:
                at = right[at] if x[feature[at]] > split[at] else left[at]
            total += float(depth[at])
        anomaly[i] = 2.0 ** (-total / len(forest.trees) / forest.norm)
    quality = {r.doc_id: r.quality for r in marks.collect() if r.quality is not None}
    good, bad = ([anomaly[i] for i, q in quality.items() if i in anomaly and (q > 0) == g] for g in (True, False))
    best, limit = 0.0, 2.0
    for k in range(qualityforest.STEPS, -1, -1):
        lost, caught = (sum(int(a * qualityforest.STEPS) >= k for a in x) / len(x) for x in (good, bad))
        if lost <= 1 - qualityforest.KEEP_GOOD and caught - lost > best:
            best, limit = caught - lost, k / qualityforest.STEPS
    got = {r.doc_id: r for r in qualityforest.judge_quality(docs, marks).collect()}
    assert all(abs(got[i].anomaly - a) < 1e-6 for i, a in anomaly.items())
    near = {i for i, a in anomaly.items() if abs(a - limit) < 1e-6}
    assert all(got[i].kept == (not got[i].base_failed and a < limit) for i, a in anomaly.items() if i not in near)
    assert any(not r.kept and not r.base_failed for r in got.values())


def test_isolated_rows_score_higher():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(size=(500, 4)), [[9, 9, 9, 9]]]).astype(np.float32)
    score = qualityforest.IsolationForest.grow(rows).score(rows)
    assert score[-1] == score.max() and (score >= 0).all() and (score <= 1).all()


def test_benchmark_passages(spark, docs):
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    want = {(i, r["item_id"]) for i, t in docs for r in items if r["text"] in t}
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op9_bm25_decontamination"](spark, SF).collect()}
    assert want and want <= got and len(got - want) <= 1


def test_wand_finds_all_above_the_threshold(docs):
    items = [(i, passage(500 + i, 20 + i % 40)) for i in range(60)]
    index = decontam.ItemIndex(items)
    r = random.Random(4)
    for _ in range(60):
        words = passage(r.randint(1, 9), 200).split()
        k = r.randrange(60)
        at = r.randrange(150)
        text = words[:at] + items[k][1].split()[: r.randint(3, 60)] + words[at:]
        words = decontam.bare_words(" ".join(text))
        score = collections.Counter()
        for term in {index.terms[w] for w in words if w in index.terms}:
            for piece, v in index.postings[term]:
                score[piece] += v
        want = {index.item_of[p]: v for p, v in score.items() if v >= index.least[p]}
        got = index.retrieve(words)
        assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_bm25_against_plain_scores(spark):
    """Verification in plain Python, from the definition, of every item in every text: no retrieval. Scores are BM25 over all items."""
    import math

    r = random.Random(12)
    vocabulary = passage(77, 400).replace(".", "").split()
    items = {i: [r.choice(vocabulary) for _ in range(r.randint(6, 60))] for i in range(90)}
    docs = {}
    for d in range(120):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 250))]
        own = list(items[r.randrange(90)])
        for _ in range(r.choice((0, 0, 1, 3, 9))):
            own[r.randrange(len(own))] = r.choice(vocabulary)
        at = r.randint(0, len(words))
        docs[d] = words[:at] + own[r.choice((0, 0, 4)) :] + words[at:]
    n, mean = len(items), sum(map(len, items.values())) / len(items)
    df = collections.Counter(w for ws in items.values() for w in set(ws))

    def weight(w, ws):
        tf = ws.count(w)
        return math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))

    want = {}
    for d, words in docs.items():
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for i, ws in items.items():
            own = {w: weight(w, ws) for w in set(ws)}
            score = sum(v for w, v in own.items() if w in words) / sum(own.values())
            cut = len(ws) - max(1, len(ws) // 3)  # one sentence: the answer is its last third
            parts = [{tuple(ws[k : k + 5]) for k in range(len(ws) - 4) if (k + 5 <= cut) == q} for q in (True, False)]
            share = [len(p & grams) / len(p) if p else 1.0 for p in parts]
            if min(share) >= 0.75:
                want[d, i] = score
    for size in (4_096, 13):
        before, decontam.PART_PIECES = decontam.PART_PIECES, size
        try:
            found = decontam.contaminated(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
            got = {(x.doc_id, x.item_id): x.score for x in found.collect()}
            assert len(want) > 30 and got == pytest.approx(want)
        finally:
            decontam.PART_PIECES = before


def test_scattered_items_are_all_retrieved():
    """Every item of which three quarters of question and answer stand in a text is retrieved, in whatever pieces and however far apart; texts
    and items of a few words, so that items repeat words and shingles. Against the overlap of each item with each text, counted one by one."""
    r = random.Random(31)
    for size in (4, 30, 2_000):
        vocabulary = [f"w{i}" for i in range(size)]
        items = [(i, " ".join(r.choices(vocabulary, k=n)) + ". " * (i % 2) + " ".join(r.choices(vocabulary, k=r.randint(1, n)))) for i, n in enumerate([1, 3, 5, 8, 13, 20, 40, 59, 64, 65, 95, 96, 97, 150, 400] * 3)]
        index = decontam.ItemIndex(items)
        hits = 0
        for k, (_, text) in enumerate(items):
            words, out = decontam.bare_words(text), []
            at = 0
            while at < len(words):
                step = r.choice((5, 9, 17, 40, 400))
                out += words[at : at + step] + [b"x%d" % r.randrange(9_999) for _ in range(r.choice((0, 70, 300)))]
                at += max(1, step - r.choice((0, 4, 4, 4)))
            for n in range(k % 4):
                out[r.randrange(len(out))] = b"y%d" % n
            grams = {n: {tuple(out[j : j + n]) for j in range(len(out) - n + 1)} for n in range(1, 6)}
            want = set()
            for i, t in items:
                ws, answer = decontam.split_item(t)
                n = min(5, len(ws))
                sides = [{tuple(ws[j : j + n]) for j in range(len(ws) - n + 1) if (j + n <= answer) == q} for q in (True, False)]
                if all(4 * len(s & grams[n]) >= 3 * len(s) for s in sides):
                    want.add(i)
            got = {hit[0] for hit in index.verify(out, index.retrieve(out), common.WordHashes()) if min(hit[2:]) >= decontam.OVERLAP}
            assert got == want
            hits += len(want)
        assert hits > 20


def test_item_in_three_places(spark):
    words = passage(61, 59).replace(".", "").split()
    text = " ".join([*words[:22], *passage(62, 70).split(), *words[18:42], *passage(63, 70).split(), *words[38:]])
    docs, bench = spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    assert [(x.doc_id, x.item_id) for x in decontam.contaminated(docs, bench).collect()] == [(1, 5)]
    assert decontam.drop_contaminated(docs, bench).count() == 0


@pytest.mark.parametrize("part", [4_096, 7])
def test_long_items_are_found(spark, part, monkeypatch):
    """Items of 20 to 3,000 words, verbatim in a document at any offset, are found; near the end of a part, too."""
    monkeypatch.setattr(decontam, "PART_PIECES", part)
    r = random.Random(8)
    sizes = (20, 64, 65, 129, 300, 3000) if part > 7 else (20, 65, 300)
    items = [(n, passage(700 + n, n - 9) + ". " + passage(900 + n, 9)) for n in sizes]
    docs = [(n, f"{passage(n, r.randint(0, 99))} {text} {passage(n + 1, r.randint(0, 99))}") for n, text in items]
    docs += [(-n, " ".join(text.split()[: n // 2])) for n, text in items]  # half an item is none
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in decontam.contaminated(d, b).collect()} == {(n, n) for n in sizes}
    assert {x.doc_id for x in decontam.drop_contaminated(d, b).collect()} == {-n for n in sizes}


def test_sentence_spans_by_hand(spark):
    a, b, c = passage(40, 25), passage(41, 25), passage(42, 25)
    rows = [(1, f"{a}\n{b}"), (2, f"{c}\n{a}"), (3, f"{b} {b}"), (4, c)]
    out = {r.doc_id: r for r in sentencespans.deduplicate_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].n_removed == 0 and out[2].kept_text.strip() == c and out[3].kept_text.strip() == "" and out[4].kept_text.strip() == ""


def test_repeated_and_missing_ids(spark):
    """Rows that share an id, or have none, are documents of their own; of rows that repeat id and text one keeps its text."""
    a, b, c = passage(40, 60), passage(41, 60), passage(42, 60)
    rows = [(7, a), (7, a), (7, a), (8, b), (8, c + "\n" + b), (None, c), (None, c + "\n" + a), (None, None), (None, None), (9, passage(43, 60))]
    for df in (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)):
        out = sorted((str(r.doc_id), r.kept_text.strip()) for r in sentencespans.deduplicate_spans(df).collect())
        assert [t for i, t in out if i == "7"] == ["", "", a] and [t for i, t in out if i == "9"] == [passage(43, 60)]
        # b and c each stand once in all that is left
        left = "\n".join(t for _, t in out)
        assert left.count(b) == 1 and left.count(c) == 1 and left.count(a) == 1 and len(out) == len(rows)


def test_spans_against_brute_force(spark, docs):
    first, want = {}, {}
    for i, text in docs:
        for h in sentencespans.spans(text)[1].tolist():
            first.setdefault(h, i)
    for i, text in docs:
        want[i] = sentencespans.cut_text(text, {h for h in sentencespans.spans(text)[1].tolist() if h and first[h] < i})[0]
    got = {r.doc_id: r.kept_text for r in sentencespans.deduplicate_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want


def test_planted_passages_are_cut(spark):
    """51 words that stand in two texts, at any offset and however punctuated, lose the middle of every 50 words; nothing else goes."""
    r, rows, planted = random.Random(11), [], {}

    def prose(k, style):
        words = ["".join(r.choice("bdfgklmnprst") + r.choice("aeiou") for _ in range(4)) for _ in range(k)]
        for i in range(k):
            if style == "tiny" and r.random() < 0.6:
                words[i] += r.choice("!.\n")
            elif style == "long" and i % 23 == 22:
                words[i] += "."
        return words

    for k in range(240):
        style = ("tiny", "long", "plain", "every")[k % 4]
        same = prose(51, style)
        if style == "every":
            same = [w + "!" for w in same]
        for d in (k, 1000 + k):
            a = prose(r.randint(0, 60), r.choice(("tiny", "long", "plain")))
            rows.append((d, " ".join([*a, *same, *prose(r.randint(0, 60), r.choice(("tiny", "long", "plain")))])))
            planted[d] = (len(a), {w.strip() for w in same})
    windows = collections.defaultdict(set)
    for d, text in rows:
        w = text.lower().split()
        for i in range(len(w) - 49):
            windows[tuple(w[i : i + 50])].add(d)
    got = {x.doc_id: x for x in sentencespans.deduplicate_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows:
        w = text.split()
        gone = {x for a, b in got[d].removed for x in text[a:b].split()}
        assert gone <= planted[d][1] and (d >= 1000 or not gone)
        for i in range(len(w) - 49):
            if min(windows[tuple(x.lower() for x in w[i : i + 50])]) < d:
                assert set(w[i + 15 : i + 35]) <= gone


def test_deobfuscation():
    words = "this is a stupid idiot and the others are moron losers with trash in it they said that".split()
    counts = collections.Counter()
    for w in words * 20:
        w = f"^^{w}$"
        counts.update(w[i : i + 3] for i in range(len(w) - 2))
    model = toxicity.CharModel(dict(counts))
    assert [toxicity.restored(w, model) for w in ("stupid,", "5tup1d", "id10t", "m0r0n!", "traaaash", "Trash")] == ["stupid", "stupid", "idiot", "moron", "trash", "trash"]
    assert "idiot" in toxicity.restore_text("you i d i o t there", model)


def test_long_digit_rich_and_spaced_disguises():
    words = "this is a stupid idiot and the others are moron losers with trash in it they said that you are today asshole shit".split()
    counts = collections.Counter()
    for w in words * 20:
        w = f"^^{w}$"
        counts.update(w[i : i + 3] for i in range(len(w) - 2))
    model = toxicity.CharModel(dict(counts))
    tokens = ("1d10t", "455h0le", "5h17", "st" + "u" * 40 + "pid", "2024", "12,345")
    assert [toxicity.restored(w, model) for w in tokens] == ["idiot", "asshole", "shit", "stupid", "2024", "12,345"]
    assert toxicity.spaced_words("you are a m o r o n today", model) == ["a", "moron"]
    assert toxicity.spaced_words("m o r o n l o s e r s", model) == ["moron", "losers"]
    assert toxicity.spaced_words(" ".join("moronlosers" * 9), model) == ["moron", "losers"] * 9


def test_no_trigram_is_cut(spark):
    r = random.Random(2)
    words = ["".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(3)) for _ in range(40_000)]
    want = collections.Counter(w[i : i + 3] for w in (f"^^{w}$" for w in words) for i in range(4))
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 1000])) for i in range(0, 40_000, 1000)], "doc_id long, text string")
    assert len(want) > 100_000 and toxicity.char_model(docs).counts == want


def test_toxicity_held_out(spark):
    t = pq.read_table("/root/testdata/sf0.1/labels.parquet")
    toxic = dict(zip(t.column("doc_id").to_pylist(), t.column("toxic").to_pylist(), strict=True))
    rows = [r for r in entry.queries()["op3_toxicity"](spark, "/root/testdata/sf0.1").collect() if r.doc_id in toxic]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    found, right = [r for r in held if r.predicted], [r for r in held if toxic[r.doc_id]]
    both = [r for r in found if toxic[r.doc_id]]
    assert len(right) >= 50 and len(both) >= 0.9 * len(right) and len(both) >= 0.9 * len(found)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = marks.withColumn("toxic", toxicity.F.when(toxicity.held_out(marks["doc_id"]), 1 - marks["toxic"]).otherwise(marks["toxic"]))
    one, two = ({r.doc_id: r.score for r in toxicity.score_toxicity(docs, m).collect()} for m in (marks, flipped))
    assert one == pytest.approx(two)


def test_shingle_hashes_agree_with_sets(docs):
    seen = common.WordHashes()
    for _, text in docs[:100]:
        assert len(common.shingles(text, seen)) == len(shingle_set(text))


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, sizes = docs, []
    for name, stage in p.STAGES[:-1]:
        kept = common.durable(stage(spark, kept, SF), "t")
        assert kept.columns == docs.columns, name
        sizes.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert all(b <= a for a, b in zip(sizes, sizes[1:], strict=False))
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in qualityforest.judge_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("kept").collect()}
    assert sizes[0] == good
    comp = components({i: shingle_set(rows[i]) for i in good})
    assert sizes[1] == {i for i in good if comp[i] == i}
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    assert not any(r["text"] in rows[i] for i in sizes[2] for r in items)
    out = p.STAGES[-1][1](spark, kept, SF)
    assert out.count() == kept.count()
