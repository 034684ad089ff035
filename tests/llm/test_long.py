"""Very long tokens and records: time in proportion, nothing lost."""

import itertools
import random
import time
from collections import Counter

import pytest

from tickloom.llm import chatfmt, toxicity
from tickloom.llm.toxicity import CharModel, decode, disguised, readings


@pytest.fixture(scope="module")
def model():
    words = "stupid idiot moron the and you are a fool hello world study plus".split()
    return CharModel(dict(Counter(f"^^{w}$"[i : i + 3] for w in words for i in range(len(w) + 1) for _ in range(len(w)))))


def test_disguised_is_what_it_was():
    import re

    before = re.compile(r"[^\W\d_].*[\d@$!|+*#€.\-_=]|[\d@$!|+*#€].*[^\W\d_]|([^\W\d_])\1\1")
    r = random.Random(1)
    for _ in range(20_000):
        token = "".join(r.choice("aab9@.-_=é中$*x") for _ in range(r.randrange(0, 7)))
        assert disguised(token) == bool(before.search(token)), token


def test_viterbi_equals_all_readings(model):
    r = random.Random(2)
    for _ in range(300):
        token = "".join(r.choice("stup1d0@$!*aee3.") for _ in range(r.randrange(1, 6)))
        best = None
        for arcs in itertools.product(*readings(token)):
            text, score, state = "".join(a for a, _ in arcs), sum(c for _, c in arcs), "^^"
            for c in text:
                score += model.log(state, c)
                state = state[1] + c
            best = max(best or (-1e9, ""), (score + model.log(state, "$"), text))
        got = decode(token, model)
        assert (got == best[1] or _score(got, token, model) == pytest.approx(best[0])), (token, got, best)


def _score(word, token, model):
    """The best score of any way to read ``token`` as ``word``."""
    best = -1e9
    for arcs in itertools.product(*readings(token)):
        if "".join(a for a, _ in arcs) == word:
            score, state = sum(c for _, c in arcs), "^^"
            for c in word:
                score += model.log(state, c)
                state = state[1] + c
            best = max(best, score + model.log(state, "$"))
    return best


@pytest.mark.parametrize("token", ["ab" * 500_000, "中文字" * 330_000, "stup1d" * 20_000, "a" * 1_000_000, "x" * 999_999 + "1"], ids=["letters", "chinese", "signs", "one", "sign-last"])
def test_long_tokens_take_seconds(model, token):
    began = time.perf_counter()
    assert toxicity.restored(token, model)
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize("kind", ["pair", "parts"])
def test_long_conversations_come_back_whole(spark, kind):
    from pyspark.sql import functions as F

    long = F.repeat(F.lit("ab<[&é"), 3_500_000)  # 21 million characters
    one = spark.range(1)
    if kind == "parts":
        turn = lambda role, text: F.struct(F.lit(role).alias("role"), F.array(F.struct(text.alias("text")), F.struct(F.lit("!").alias("text"))).alias("content"))
        records = one.select(F.lit(1).alias("conv_id"), F.to_json(F.struct(F.array(turn("user", F.lit("hi")), turn("assistant", long)).alias("messages"))).alias("record"))
        want, n = "!", 2
    else:
        roles = ["user", "assistant"]
        rows = one.select(F.lit(1).alias("conv_id"), F.posexplode(F.array(*[F.lit(r) for r in roles])).alias("turn", "role")).withColumn("text", F.when(F.col("turn") == 1, long).otherwise("hi"))
        records, n = chatfmt.conversation_records(rows), len(roles)
        want = ""
    got = chatfmt.read_back(chatfmt.format_chats(records, mappings=chatfmt.AS_THEY_STAND)).select("n_turns", "loss_chars", "loss_sha256").first()
    import hashlib

    text = "ab<[&é" * 3_500_000 + want
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (n, len(text), hashlib.sha256(text.encode()).hexdigest())
