import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import crf_private
from tests.llm.test_operators import frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """The base spans by the patterns as they are written down."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = {
        "email": list(EMAIL.finditer(text)),
        "ip": [m for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and crf_private.luhn(digits(m))],
        "phone": [m for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }
    return [(kind, m.start(), m.end()) for kind, matches in found.items() for m in matches]


@given(st.text(st.sampled_from("a1@@.._-+ é()\n"), max_size=40))
@settings(max_examples=3000, deadline=None)
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert crf_private.base_spans(text) == plain_spans(text)


def test_base_spans_of_numbers():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice(["4111111111111111", "4111 1111 1111 1111", "+44 20 7946 0018", "1.2.3.4", "256.1.1.1", ".", " ", "-", "9", "a@b.c"]) for _ in range(6))
        assert crf_private.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def chain():
    return crf_private.trained()


@pytest.mark.parametrize("text", ["1" * 10**6, "a" * 10**6 + "@", "a@" + "b" * 10**6, "1." * 500_000, "@" * 10**6, "a.@" * 330_000, "." * 10**6 + "1"])
def test_a_million_signs_take_seconds(chain, text):
    begin = time.process_time()
    base = crf_private.base_spans(text)
    assert time.process_time() - begin < 1.5
    assert crf_private.spans_of([text], chain, {})[0][0] == base
    assert time.process_time() - begin < 8


def test_time_follows_the_length(chain):
    for piece in ("123 ", "1 - ", "+1 ", "x @ ", "a at b dot "):
        took = []
        for many in (5_000, 20_000):
            begin = time.process_time()
            crf_private.spans_of([piece * many], chain, {})
            took.append(time.process_time() - begin)
        assert took[1] < 10 * took[0] + 0.5


def test_long_runs_decode_like_short_ones():
    for words in (1, 2, 3, 17, 100, 513, 2000):
        logits = np.random.default_rng(words).normal(size=(words, 9))
        step = np.random.default_rng(words + 1).normal(size=(9, 9))
        step[3, 4] = -30
        assert crf_private.viterbi_long(logits, step).tolist() == crf_private.viterbi(logits[None], np.array([words]), step)[0].tolist()


def written(rng):
    """A private value written so that no pattern finds it, in a sentence of its own."""
    n = lambda k: "".join(rng.choice("123456789") for _ in range(k))
    name, host = rng.choice(["maria", "j.doe", "info", "k_lee", "sales"]), rng.choice(["acme", "mail-x", "north", "beta"])
    kind, value = rng.choice([
        ("phone", f"{n(3)} - {n(3)} - {n(4)}"), ("phone", f"( {n(3)} ) {n(3)} {n(4)}"), ("phone", f"0{n(2)}/{n(6)}"), ("phone", f"({n(3)}) {n(3)}-{n(4)}"),
        ("email", f"{name} @ {host}.example"), ("email", f"{name} at {host} dot org"), ("email", f"{name} (at) {host} (dot) com"),
    ])
    lead = {"phone": ["call", "phone:", "tel", "fax", "mobile"], "email": ["write to", "mail", "ask", "reach"]}[kind]
    return kind, value, f"then they said {rng.choice(lead)} {value} {rng.choice(['today', 'please', 'at once', 'or wait'])} and left"


def test_recall_of_values_no_pattern_finds(chain):
    rng = random.Random(3)
    cases = [written(rng) for _ in range(600)]
    caught = {}
    for (kind, value, text), (base, every) in zip(cases, crf_private.spans_of([t for *_, t in cases], chain, {}), strict=True):
        assert not base
        low = text.index(value)
        hit = any(k == kind and a <= low + 2 and b >= low + len(value) - 1 for k, a, b in every)
        caught.setdefault(kind, []).append(hit)
    assert {k: sum(v) / len(v) >= 0.9 for k, v in caught.items()} == {"phone": True, "email": True}


def test_plain_numbers_are_left_alone(chain):
    rng = random.Random(4)
    makes = [
        lambda: f"on {rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)} it was {rng.randint(1, 99)} - {rng.randint(1, 99)}",
        lambda: f"about {rng.randint(10, 999)} of {rng.randint(1000, 9999)} people in {rng.randint(1900, 2030)}",
        lambda: f"pages {rng.randint(1, 99)} - {rng.randint(100, 199)} and {rng.randint(200, 300)} / {rng.randint(300, 400)}",
        lambda: f"open {rng.randint(8, 12)} - {rng.randint(13, 20)} daily , 10:{rng.randint(10, 59)} at the latest",
        lambda: f"they met at {rng.choice(['home', 'work', 'noon'])} and a dot was seen",
    ]
    texts = [rng.choice(makes)() for _ in range(500)]
    wrong = [t for t, (_, every) in zip(texts, crf_private.spans_of(texts, chain, {}), strict=True) if every]
    assert len(wrong) <= 10, wrong[:5]


def test_helper_names_as_input_columns(spark):
    df = spark.createDataFrame([(1, "a@b.cd", 5)], "doc_id long, text string, _found int")
    row = crf_private.searched(df).collect()[0]
    assert row["_found"] == 5 and len(row["base_spans"]) == 1
    assert len(crf_private.searched(frame(spark, [(1, None), (2, "")])).collect()) == 2
