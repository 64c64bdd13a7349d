"""Personal data: plain patterns by brute force, disguises mapped back to the source, odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from layercake.llm import pii, queries
from layercake.session import table
from tests.conftest import SF_CHECK


def _plain(text):
    """The base patterns as they are written in the contract."""
    out = []
    for k, pattern in enumerate(
        [
            r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]",
        ]
    ):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
            good = [
                True,
                k == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                14 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                10 <= len(digits) <= 15,
            ][k]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_detectors_equal_the_patterns():
    rng = random.Random(3)
    pieces = ["a", "B", "1", "23", "255", "256", "4111111111111111", "@", ".", "-", "+", " ", "(", ")", "x.y", "é", "%", "_", "\n", "555", "0"]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        assert pii.detect(text) == _plain(text), text
    digits = ["0", "1", "4", "9", " ", "-", "+", ".", "(", ")"]
    for _ in range(20_000):
        text = "".join(rng.choices(digits, weights=[4, 4, 4, 4, 1, 1, 1, 1, 1, 1], k=rng.randint(10, 30)))
        assert pii.detect(text) == _plain(text), text


@pytest.mark.parametrize(
    "kind, source",
    [
        ("email", "john.doe [at] example [dot] com"),
        ("email", "john(at)example.com"),
        ("email", "jane dot roe at mail dot example dot org"),
        ("email", "jоhn@exаmple.com"),  # Cyrillic letters
        ("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("email", "jo​hn@exam­ple.com"),
        ("email", "john&#64;example.com"),
        ("email", "maria { arroba } ejemplo {punto} es"),
        ("email", "𝐣𝐨𝐡𝐧@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦"),
        ("phone", "plus one two zero two five five five zero one two three"),
        ("phone", "+1 (2O2) 555-0l23"),
        ("phone", "+４９ ３０ １２３４５６７"),
        ("card", "four one one one one one one one one one one one one one one one"),
        ("card", "4111 1111‑1111 1111"),
        ("card", "4111 l111 11l1 1111"),
        ("card", "٤١١١١١١١١١١١١١١١"),
        ("ip", "192[.]168[.]1[.]20"),
        ("ip", "one nine two dot one six eight dot one dot one"),
        ("ip", "eins neun zwei punkt eins sechs acht punkt eins punkt zwei"),
    ],
)
def test_disguises_are_mapped_back(kind, source):
    """The span is that of the disguise in the source, whatever stands around it."""
    for before, after in (("", ""), ("Wörter 𝒳 davor: ", " et après ça")):
        text = before + source + after
        want = (len(before), pii.KINDS.index(kind), len(before) + len(source), False)
        assert want in pii.find(text), pii.find(text)


def test_base_spans_stay_and_clean_texts_have_none():
    text = "a@b.de, 10.0.0.1 and john [at] example [dot] com, +49 30 1234567, 4111 1111 1111 1111"
    spans = pii.find(text)
    assert [s[:3] for s in spans if s[3]] == _plain(text)
    assert [text[a:b] for a, k, b, base in spans if not base] == ["john [at] example [dot] com"]
    for clean in (
        "One two three men met at noon; un, deux, trois.",
        "Привет, как дела? Ναι, καλά.",
        "Look at the second point. At 10.5 percent, plus 3 more.",
        "Un deux trois quatre cinq six sept huit",
        "version 1.2.3, 12 May 2020, 10 000 000 000 plus 5",
        "the 2O10 and l0 marks, é" * 50,
    ):
        assert pii.find(clean) == [], clean


@pytest.mark.parametrize(
    "text",
    ["x" * 300_000, "@" * 100_000, "a@" * 100_000, " at " * 50_000, "one " * 50_000, "1." * 100_000, " " * 300_000, "+1" * 100_000,
     "l" * 200_000 + "1", "dot " * 50_000, "​" * 100_000, "a dot " * 30_000 + "at b dot co", "1" * 300_000],
)
def test_time_is_linear_in_the_text(text):
    """Long runs of one sort that a backtracking pattern would need hours for."""
    pii.find(text)


def test_rows_pass_whole(spark):
    """NULL, empty and long texts, repeated rows, columns of any name, an empty table."""
    long = "é " * 500_000 + "a [at] b [dot] de"
    rows = [(1, None, "x"), (1, None, "x"), (2, "", None), (None, "me@here.org", "y"), (3, long, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `a.spans` string")
    got = pii.find_pii(frame, masked_col="masked").collect()
    assert len(got) == 5 and [r["a.spans"] for r in got] == ["x", "x", None, "y", "z"]
    assert [len(r["spans"]) for r in got] == [0, 0, 0, 1, 1]
    assert got[3]["masked"] == "*" * 11 and got[0]["masked"] is None
    assert got[4]["masked"] == long[:1_000_000] + "*" * 17
    assert tuple(got[4]["spans"][0]) == ("email", 1_000_000, 1_000_017, False)
    assert pii.find_pii(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pii.find_pii(frame.withColumnRenamed("doc_id", "spans"))


def test_query_equals_the_patterns(spark):
    """Counts and digest of the supplied documents' base spans; they hold no disguise."""
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_CHECK, "documents").collect()}
    got = queries.QUERIES["op12_pii"](spark, SF_CHECK).collect()
    assert len(got) == len(texts)
    for r in got:
        want = _plain(texts[r["doc_id"]])
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in want) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["spans"] == listed
