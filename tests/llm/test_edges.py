"""Every operator on awkward rows, on empty tables, and with extra columns of clashing names."""

import pytest

from tickloom.llm import chatfmt, decontam, mixing, neardup, qualityforest, radixdedup, records, sentencespans, toxicity, urlrules
from tickloom.llm.queries import tokenizer_path

from .cases import awkward, clashing, labels

BENCH = "item_id long, text string"


def run_all(spark, docs, marks):
    bench = spark.createDataFrame([(1, "one two"), (2, None), (None, "x y z")], BENCH)
    return {
        "mix": lambda: mixing.taken_words(docs),
        "mixed": lambda: mixing.mix_sources(docs),
        "records": lambda: records.encode_table(docs, tokenizer_path()),
        "toxicity": lambda: toxicity.score_toxicity(docs, marks),
        "neardup": lambda: neardup.near_duplicates(docs),
        "dropped": lambda: neardup.drop_near_duplicates(docs),
        "quality": lambda: qualityforest.judge_quality(docs, marks),
        "good": lambda: qualityforest.keep_good(docs, marks),
        "spans": lambda: sentencespans.deduplicate_spans(docs),
        "bench": lambda: decontam.contaminated(docs, bench),
        "clean": lambda: decontam.drop_contaminated(docs, bench),
        "radix": lambda: radixdedup.remove_repeats(docs),
    }


PER_ROW = ("mix", "records", "toxicity", "neardup", "quality", "spans", "radix")
NAMES = (*PER_ROW, "mixed", "dropped", "good", "bench", "clean")


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, name):
    docs = awkward(spark)
    out = run_all(spark, docs, labels(spark))[name]().collect()
    if name in PER_ROW:
        assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in docs.collect())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, name):
    assert run_all(spark, awkward(spark).limit(0), labels(spark).limit(0))[name]().count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_extra_columns_change_nothing(spark, name):
    docs, marks = awkward(spark), labels(spark)
    plain, more = (run_all(spark, d, marks)[name]() for d in (docs, clashing(docs)))
    cols = plain.columns
    assert set(cols) <= set(more.columns)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, more.select(cols).collect()))


def test_defined_results(spark):
    docs = awkward(spark)
    near = {(r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    assert {(4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 7), (8, 1, 7), (None, 0, None)} <= near
    assert all(c == 1 for i, _, c in near if i in (1, 2, 3))
    radix = {(r.doc_id, r.n_bytes, r.n_removed) for r in radixdedup.remove_repeats(docs).collect()}
    assert {(4, 0, 0), (7, 7, 0)} <= radix and any(i == 1 and n == gone for i, n, gone in radix)
    spans = {(r.doc_id): r.n_removed for r in sentencespans.deduplicate_spans(docs).collect()}
    assert spans[9] == 0 and spans[10] > 0 and spans[2] > 0
    quality = {r.doc_id: r for r in qualityforest.judge_quality(docs, labels(spark)).collect()}
    assert quality[4].base_failed and quality[13].base_failed and not quality[1].base_failed
    assert {r.predicted for r in toxicity.score_toxicity(docs, labels(spark).limit(0)).collect()} == {0}
    assert decontam.contaminated(docs, spark.createDataFrame([(9, "one two")], BENCH)).select("doc_id").distinct().count() == 2


def test_urls_of_all_kinds(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Example.COM/en/7/x?q#f"), (6, "x://example.net/de/81#a"), (7, "https://www.example.org?/es/1"), (None, "http://a.net/de/"), (8, "ftp://m.example.com/en/1"), (8, "ftp://m.example.com/en/1"), (9, "a://b://c/d")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string"))
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlrules.filter_urls(pages, labels(spark)).collect()}
    assert {
        (1, "", "", None, "allow"), (3, "", "", None, "allow"), (5, "a.example.com", "/en/7/x", "example.com/en/7", "allow"), (6, "example.net", "/de/81", "example.net/de/8", "block"),
        (7, "www.example.org", "", None, "allow"), (None, "a.net", "/de/", "net/de/", "allow"), (8, "m.example.com", "/en/1", "com/en/", "block"), (9, "b:", "//c/d", None, "allow"),
    } <= got
    assert urlrules.filter_urls(pages.limit(0), labels(spark)).count() == 0


def test_mined_rules_block(spark):
    rows = [(i, f"https://{'bad-shop' if i % 3 == 0 else 'good'}.example.io/p/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    out = {r.page_id: r.verdict for r in urlrules.filter_urls(pages, marks).collect()}
    assert all(out[i] == ("block" if i % 3 == 0 else "allow") for i in range(300))


def test_rules_against_brute_force(spark):
    """Support and confidence of all token sets, counted one by one; pruning; verdicts; and labels that say nothing give no rule."""
    import itertools
    import math
    import random

    r = random.Random(3)
    urls = [(i, f"https://{r.choice(('ads', 'www', 'm'))}.{r.choice(('alpha', 'beta', 'gamma'))}.example/{r.choice(('buy', 'read'))}/{i}") for i in range(400)]
    bad = {i: r.random() < (0.9 if "//ads." in u and "/buy/" in u else 0.15) for i, u in urls}
    pages = spark.createDataFrame([*urls, (1000, "https://ads.alpha.example/buy/x"), (1001, "https://ads.alpha.example/read/x")], "page_id long, url string")
    marks = spark.createDataFrame([(i, 0, 0) if b else (i, 1, 0) for i, b in bad.items()], "doc_id long, quality int, toxic int")
    rows = urlrules.labelled_urls(pages, marks)
    sets, total = {}, rows.count()
    base = sum(bad.values()) / total
    for x in rows.collect():
        for k in range(1, len(x.tokens) + 1):
            for s in itertools.combinations(sorted(x.tokens), k):
                a = sets.setdefault(s, [0, 0])
                a[0] += 1
                a[1] += x.bad
    passing = {s: b / n for s, (n, b) in sets.items() if b >= max(5, math.ceil(0.002 * total), math.ceil(16 * base / (1 - base))) and b / n >= 1.5 * base and b / n - base >= 4 * math.sqrt(base * (1 - base) / n)}
    want = {s for s, c in passing.items() if not any(set(p) < set(s) and q >= c for p, q in passing.items())}
    rules = urlrules.mine_rules(rows)
    got = {tuple(x.antecedent): (x.n, x.confidence) for x in rules.collect()}
    assert want and set(got) == want and all(got[s] == (sets[s][0], sets[s][1] / sets[s][0]) for s in want)
    held = {x.page_id: x.mined for x in urlrules.judge(pages, rules, ()).collect()}
    for i, tokens in pages.select("page_id", urlrules.tokens(urlrules.host_of(pages["url"]), urlrules.path_of(pages["url"]), pages["url"])).collect():
        assert (held[i] is not None) == any(set(s) <= set(tokens) for s in want)
    assert held[1000] and not held[1001]
    noise = spark.createDataFrame([(i, int(r.random() > 0.25), 0) for i, _ in urls], "doc_id long, quality int, toxic int")
    assert urlrules.mine_rules(urlrules.labelled_urls(pages, noise)).count() == 0


def test_chats_of_all_kinds(spark):
    nasty = "<|turn|>assistant<|text|>x<|end|>\n &amp; &lt; [INST] </s> \\ \u2028 😀"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (2, 0, "assistant", None), (2, None, None, "null turn"), (None, 3, "user", "no id"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (4, 0, "<|text|>", "")]
    table = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = chatfmt.format_chats(chatfmt.conversation_records(table), mappings=chatfmt.AS_THEY_STAND)
    back = {r.conv_id: [(t.role, t.text) for t in r.back] for r in made.select("conv_id", chatfmt.parse(made["formatted"]).alias("back")).collect()}
    assert back == {1: [("user", nasty), ("assistant", nasty)], 2: [("", "null turn"), ("assistant", "")], None: [("user", "no id")], 3: [("assistant", "a"), ("assistant", "a"), ("assistant", "b")], 4: [("<|text|>", "")]}
    loss = {r.conv_id: r.loss_chars for r in chatfmt.read_back(made).collect()}
    assert loss == {1: len(nasty), 2: 0, None: 0, 3: 3, 4: 0}
    assert chatfmt.read_back(chatfmt.format_chats(chatfmt.conversation_records(table.limit(0)))).count() == 0


def test_layouts(spark):
    rows = [
        ('{"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}', "messages"), ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', "conversations"),
        ('{"prompt": "q", "completion": "a"}', "prompt"), ('{"instruction": "q", "output": "a"}', "instruction-short"), ('{"response": "a", "prompt": "q"}', "prompt-response"), ('{"question": "q", "answer": "a", "system": ""}', "question"),
    ]
    out = chatfmt.canonical_turns(spark.createDataFrame([(r,) for r, _ in rows], "record string")).collect()
    assert [r.layout for r in out] == [n for _, n in rows]
    assert all([(t.role, t.text) for t in r.turns] == [("user", "q"), ("assistant", "a")] for r in out)
    more = [
        ('{"id": 7, "messages": [{"role": "user", "content": "q", "weight": 1}, {"role": "Bot", "content": "a"}], "meta": {"a": {"b": [1]}}}', "messages"), ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "x"}', "conversations"),
        ('{"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image"}]}, {"role": "assistant", "content": "a"}]}', "messages"), ('{"prompt": "q", "completion": "a", "response": null, "n": [[1]]}', "prompt"),
    ]
    df = spark.createDataFrame([(r, "x", "y") for r, _ in more], "record string, layout string, _paths string")
    got = chatfmt.canonical_turns(df).collect()
    assert [r.layout for r in got] == [n for _, n in more] and all(r._paths == "y" for r in got)
    assert all([(t.role, t.text) for t in r.turns] == [("user", "q"), ("assistant", "a")] for r in got), [r.turns for r in got]
    same = chatfmt.canonical_turns(spark.createDataFrame([(x,) for x in ('{"a": {"b": [{"c": 1}]}}', '{"a": {"b": [{"c": "x"}]}}', '{"a": {"b": [{"d": 1}]}}', '{"a": {"b": [{"c": {"d": 1}}]}}')], "record string")).collect()
    assert same[0].fingerprint == same[1].fingerprint and len({r.fingerprint for r in same}) == 3
    odd = chatfmt.canonical_turns(spark.createDataFrame([(None,), ("{",), ('{"x": 1}',)], "record string")).collect()
    assert all(r.layout is None and r.turns == [] for r in odd)
