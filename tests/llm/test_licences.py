import random
import textwrap

import pytest
from pyspark.sql import functions as F

from weirgauge.llm import licences


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    prose = lambda n: " ".join(r.choice(["the", "of", "thing", "under", "work", "is", "public", "version", "general", "and", "ered", "nd"]) for _ in range(n))
    made = {}
    for i in range(200):
        made[i] = ("\n".join(prose(r.randint(3, 60)) for _ in range(3)), [])
    i = 1000
    for family, texts in licences.TEXTS.items():
        for text in texts:
            made[i] = (f"{prose(20)}\n{text}\n{prose(10)}", [family])
            made[i + 1] = (text.upper(), [family])
            made[i + 2] = (f"{prose(70)} {text} {prose(60)}", [family])
            i += 3
    made[2000] = ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", ["CC-BY-NC-4.0", "MIT"])
    made[2001] = ("You need a license to drive under the general terms.", [])
    gpl = licences.TEXTS["GPL-3.0"][1] + ", or (at your option) any later version."
    wrap = lambda text, mark, n=70: "\n".join(mark + line for line in textwrap.wrap(text, n))
    made[2100] = (wrap("This program is free software: " + gpl, ""), ["GPL-3.0"])
    made[2101] = (f"{prose(30)}\n\n{wrap('This program is free software; ' + gpl.replace('version 3', 'version 2'), '# ')}\n#\n# {prose(9)}", ["GPL-2.0"])
    made[2102] = (wrap(licences.TEXTS["BSD-3-Clause"][1], " * ") + f"\n *\n * {prose(12)}", ["BSD-3-Clause"])
    made[2103] = (wrap(licences.TEXTS["ISC"][1], "// ", 40), ["ISC"])
    for i, (text, family) in enumerate(
        [
            ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
            ("GNU Lesser General Public License, version 3.", None),
            ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
            ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
            ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
            ("Licensed under CC BY-NC 3.0.", None),
            ("Licensed under the Apache License, Version 1.1.", None),
        ]
    ):
        made[2200 + i] = (f"{prose(12)}\n{text}\n{prose(5)}", [family] if family else [])
    made[2002] = (None, [])
    made[2003] = ("", [])
    made[2004] = ("word " * 20000, [])
    return made


def test_scan(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, (t, _) in rows.items()] + [(None, None, "x", 1.0), (3, rows[3][0], "x", 1.0)], "doc_id long, text string, families string, score double").repartition(3)
    got = licences.scanned(docs).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert 0 <= r.score <= 1 and (r.family in r.families if r.families else r.family is None)
        if r.doc_id is not None:
            assert r.families == rows[r.doc_id][1], (r, rows[r.doc_id][0][:80] if rows[r.doc_id][0] else None)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert licences.scanned(docs).count() == 0


def test_words_and_windows(spark):
    row = spark.range(1).select(licences.words(F.lit("Version 2.0. v. 2.0, CC BY-NC 4.0.\x0bÉté")).alias("w"), F.transform(licences.windows(F.lit("a " * 130)), F.size).alias("n"), licences.grams(licences.words(F.lit("a b c")), 2).alias("g")).first()
    assert row.w == ["version", "2.0", "v", "2.0", "cc", "by", "nc", "4.0", "été"] and row.g == ["a b", "b c"]
    assert row.n == [48, 48, 48, 48, 34]
