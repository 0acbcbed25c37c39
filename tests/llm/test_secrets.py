"""The Markov models of the secret scan: planted strings of several alphabets, ordinary strings, long and repeated texts."""

from __future__ import annotations

import random
import string
import time

import numpy as np
import pytest

from affinia.llm import secrets

DOCS = "doc_id bigint, text string"
KEYS = {
    "letters and digits": string.ascii_letters + string.digits,
    "lower case and digits": string.ascii_lowercase + string.digits,
    "base 32": string.ascii_uppercase + "234567",
    "base 64": string.ascii_letters + string.digits + "+/",
}
PLAIN = """2024-01-01T00/00/00 2031-12-24T18-30-59Z /usr/local/share/applications/mimeinfo.cache getUserAccountByIdentifier
org.apache.spark.sql.execution.streaming MAX_RETRY_ATTEMPTS_EXCEEDED some-long-kebab-case-identifier www.wikipedia.org/wiki/Mountain_climbing
AbstractSingletonProxyFactoryBean 1234567890123456 192.168.100.100-192.168.100.200 libstdc++.so.6.0.28 version-10.4.2-SNAPSHOT.jar
==================== -------------------- 00000000000000000000 xxxxxxxxxxxxxxxxxxxxxxxx IMG_20240101_120000.jpg
HTTPServletRequestWrapperImpl x86_64-unknown-linux-gnu internationalization/localization""".split()


def keys(alphabet, n, size, seed=99):
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(size)) for _ in range(n)]


@pytest.fixture(scope="module")
def prior():
    """The models of a corpus without secrets or words: only the labelled samples speak."""
    none = np.zeros(secrets._SIZE**3)
    return secrets.ratios(none, none)


@pytest.mark.parametrize("kind", KEYS)
def test_random_strings_are_found_bare_and_joined(prior, kind):
    for size in (20, 32, 40):
        made = keys(KEYS[kind], 100, size)
        for before, after in (("", ""), ("/client/session_key=", "/config"), ("release.", "")):
            found = 0
            for key in made:
                text = f"see {before}{key}{after} here"
                spans = [text[a:b] for k, a, b in secrets.spans_of(text, prior)[1] if k == "markov"]
                found += any(len(s) >= 0.7 * size and s in before + key + after for s in spans)
            assert found >= 90


def test_ordinary_strings_raise_no_alarm(prior):
    assert [x for x in PLAIN if secrets.spans_of(x, prior)[1]] == []


def test_two_keys_of_one_token_and_spans_beside_base_ones(prior):
    one, two = keys(KEYS["letters and digits"], 2, 30)
    token = f"{one}/service/configuration/directory/{two}"
    assert secrets.best_stretches(token, prior) == [(0, 30), (len(token) - 30, len(token))]
    text = f"token={one} {two}"
    base, both = secrets.spans_of(text, prior)
    assert base == [("assign", 0, 36)] and both == [*base, ("markov", 37, 67)]


def test_scan_learns_from_the_texts(spark, prior):
    # Names of a style that the samples lack are ordinary once the texts are full of its words; a key that is repeated is not.
    style = ["".join(random.Random(i).choices(["zqx", "qzk", "xjq"], k=4 if i < 390 else 8)) for i in range(400)]
    key = keys(KEYS["letters and digits"], 1, 32)[0]
    table = [(i, f"{w} and {w}") for i, w in enumerate(style)] + [(900, f"a {key}")] * 50 + [(901, None), (902, "")]
    table.append((903, f"password={key} " + "word " * 200_000 + key))
    docs = spark.createDataFrame(table, DOCS).selectExpr("*", "'mine' as spans", "1 as n_hex")
    got = secrets.scan(docs, secrets.train(docs)).collect()
    assert len(got) == len(table)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got}
    assert spans[900] == [("markov", 2, 34)] and spans[901] == spans[902] == []
    assert [s[0] for s in spans[903]] == ["assign", "markov"]
    assert all(not spans[i] for i in range(400)) and secrets.best_stretches(style[399], prior)
    assert secrets.scan(docs.limit(0), secrets.train(docs.limit(0))).count() == 0


def test_long_texts_take_time_in_proportion(prior):
    began = time.monotonic()
    secrets.spans_of("Ab3/" * 250_000, prior)  # one token of a million characters
    secrets.spans_of("token=abcdefgh " * 60_000 + "averylongplainwordindeed " * 20_000, prior)  # many base spans, many tokens
    assert time.monotonic() - began < 30
