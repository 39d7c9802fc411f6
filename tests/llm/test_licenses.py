import textwrap

from compare import connect, differences
from pyspark.sql import functions as F

from logweir.llm import licenses
from logweir.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark, sf_dir):
    df = QUERIES["op1_license_scan"](spark, sf_dir)
    assert differences(df, connect(sf_dir), ORACLES["op1_license_scan"]) is None
    assert df.where("notices != ''").count() > 0


def variants(text):
    yield text
    yield "Copyright (c) 2020 Somebody\n\n" + text.upper()
    yield "  © 1999, A. N. Other. All rights reserved.\n" + text.replace(" ", "  ").replace(",", " ,")
    yield text.replace("license", "licence").replace("\n", "\n * ")
    yield text.replace("authorized", "authorised").replace('"', "''")


def test_reformatted_licences_are_recognised(spark, docs_of):
    rows, expected = [], {}
    for name, text in licenses.KNOWN:
        for variant in variants(text):
            expected[len(rows)] = name
            rows.append((len(rows), variant))
    changed = licenses.KNOWN[0][1].replace("free of charge", "for a charge")
    for other in (changed, "", None, "prose\n" + licenses.KNOWN[0][1], "...\n---"):
        expected[len(rows)] = None
        rows.append((len(rows), other))
    got = {r.doc_id: r.license for r in licenses.scan(docs_of(rows), licenses.known_licenses(spark)).collect()}
    assert got == expected


TITLES = {"MIT": "The MIT License (MIT)", "ISC": "ISC License", "BSD-3-Clause": 'BSD 3-Clause "New" or "Revised" License', "Zlib": "zlib License"}


def test_wrapping_titles_and_notices_do_not_matter(spark, docs_of):
    rows, expected = [], {}
    for name, text in licenses.KNOWN:
        if len(text.split()) < 25:
            continue
        for width in (60, 72, 80, 10**6):
            body = "\n".join(textwrap.wrap(" ".join(text.split()), width))
            title = TITLES.get(name, "")
            for head in ("", f"{title}\n\nCopyright (c) 2019-2024 The Authors of It, Inc. All rights reserved.\n\n", f"{title} Copyright 2020 A. N. Other <a@b.c> "):
                # Where a notice and the text are one line, the text's opening words end the notice.
                opens = any(" ".join(body.lower().split()).startswith(x) for x in licenses.OPENINGS)
                if head.endswith("\n") or not head or opens:
                    expected[len(rows)] = name
                    rows.append((len(rows), head + body))
    got = {r.doc_id: r.license for r in licenses.scan(docs_of(rows), licenses.known_licenses(spark)).collect()}
    assert len(rows) > 100 and len(licenses.KNOWN) >= 40
    assert got == expected


def test_what_is_no_notice_stays(spark):
    texts = ["copyright holders be liable for any claim", "(c) in the event of 3 years", "copyright notice and this"]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    got = rows.select(licenses.canonical_lines(F.col("text")).alias("lines")).collect()
    assert [" ".join(r.lines) for r in got] == ["copyright holders be liable for any claim", "c in the event of 3 years", "copyright notice and this"]


def test_notices_and_edges(spark, docs_of):
    text = "some words\nRELEASED under the MIT licence!\nmore\nLicensed under CC BY-NC 4.0\n"
    docs = docs_of([(1, text), (1, text), (None, text), (2, None), (3, "x " * 40_000 + "\nMIT License")])
    got = licenses.scan(docs, licenses.known_licenses(spark)).collect()
    assert len(got) == 5
    assert sorted(r.notices for r in got) == ["", "CC-BY-NC-4.0,MIT", "CC-BY-NC-4.0,MIT", "CC-BY-NC-4.0,MIT", "MIT"]
    assert licenses.scan(docs.limit(0), licenses.known_licenses(spark)).count() == 0
    assert licenses.scan(docs, licenses.known_licenses(spark).limit(0)).where("license is not null").count() == 0
