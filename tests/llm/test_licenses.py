"""Licence notices that are wrapped over lines, and those within long texts without line ends."""

import textwrap

import pytest
from sunledger.llm import licenses

MIT, GPL, APACHE = licenses.TEMPLATES["mit"][4], next(t for t in licenses.TEMPLATES["gpl"] if t.startswith("This program")), licenses.TEMPLATES["apache-2.0"][1]
NAMES = ["river", "stone", "window", "green", "walks", "under", "the", "old", "bridge", "of", "a", "town", "and", "sees", "many", "boats", "in", "summer", "with", "people"]


def prose(n, seed):
    return " ".join(NAMES[(i * i + seed * i + i // 7) % len(NAMES)] for i in range(n))


TEXTS = {
    1: ("mit",), 2: ("gpl",), 3: ("apache-2.0", "mit"), 4: ("mit",), 5: ("gpl",), 6: (), 7: ("cc-by-nc",), 8: ("cc-by",), 9: ("all-rights-reserved", "bsd"), 10: ("mit",),
}


@pytest.fixture(scope="module")
def scanned(spark):
    comment = "\n".join(f" * {x}" for x in textwrap.wrap(GPL, 70))
    texts = {
        1: prose(50, 1) + ".\n\n" + textwrap.fill(MIT, 72) + "\n\n" + prose(30, 2),
        2: "/*\n * tool.c\n *\n" + comment + "\n */\n" + prose(20, 3),
        3: prose(3000, 4) + ". " + MIT + " " + prose(2000, 5) + ". " + APACHE + " " + prose(100, 6),
        4: prose(1501, 7) + ". Released under the MIT License. " + prose(1500, 8),
        5: prose(5, 9) + "\n" + textwrap.fill(GPL, 80),
        6: prose(4000, 10) + ". " + " ".join(MIT.split()[:8]) + " " + prose(400, 11) + "\nThe license of the driver was free of charge.",
        7: prose(40, 12) + ". " + licenses.TEMPLATES["cc-by-nc"][1] + " " + prose(40, 13),
        8: textwrap.fill(licenses.TEMPLATES["cc-by"][3], 30),
        9: "Copyright 2020 The Authors. All rights reserved.\n" + textwrap.fill(next(t for t in licenses.TEMPLATES["bsd"] if t.startswith("Redistributions")), 60),
        10: textwrap.fill(MIT, 40),
    }
    docs = spark.createDataFrame([*texts.items(), *((100 + i, prose(300, i)) for i in range(50))], "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.scan(docs, licenses.fit(docs)).collect()}


@pytest.mark.parametrize("doc", sorted(TEXTS))
def test_notice(scanned, doc):
    assert sorted({n["family"] for n in scanned[doc]["notices"] if n["confirmed"]}) == sorted(TEXTS[doc])


def test_paragraphs(scanned):
    assert (scanned[1]["n_paragraphs"], scanned[5]["n_paragraphs"]) == (5, 1)
    assert [n["paragraph"] for n in scanned[1]["notices"] if n["confirmed"]] == [2]
