import pytest
from llm_cases import clashing, documents

from chatloom.llm import license_scan as op
from chatloom.llm.license_texts import LICENSES, NOTICES


def test_variants_of_whole_texts(spark):
    mit = LICENSES["MIT"]
    texts = ["MIT License text follows", "Copyright (c) 2020 Someone\n\n" + mit, mit.upper().replace("\n", "\r\n"), "  " + mit.replace(",", " ;").replace("\n", "   "),
             "© 1999 A. Person. All rights reserved.\nCopyright 2001-2004, B\n" + LICENSES["Zlib"].replace("acknowledgment", "acknowledgement"),
             mit + " extra", "some text\n" + mit, LICENSES["ISC"].replace("NEGLIGENCE", "negligence"), LICENSES["0BSD"]]
    got = {r.doc_id: r.license_text for r in op.scan(documents(spark, texts)).collect()}
    assert got == {0: None, 1: "MIT", 2: "MIT", 3: "MIT", 4: "Zlib", 5: None, 6: None, 7: "ISC", 8: "0BSD"}


def test_notice_lines(spark):
    texts = ["prose\nReleased under the MIT Licence!\nmore", "Licensed under the Apache License, Version 2.0.", "licensed under the mit license\nLICENSED UNDER CC BY-NC 4.0",
             "It is Released under the MIT License. And more.", None, "", "\n\n", "Released under the MIT License.\n" * 3]
    docs = clashing(documents(spark, texts), "digest", "license_id", "whole", "doc", "license_text")
    got = {r.doc_id: (r.license_text, r.license_notices) for r in op.scan(docs).collect()}
    assert got == {0: (None, "MIT"), 1: ("Apache-2.0", "Apache-2.0"), 2: (None, "CC-BY-NC-4.0,MIT"), 3: (None, None), 4: (None, None),
                   5: (None, None), 6: (None, None), 7: (None, "MIT")}


def test_digests_are_distinct_and_bounded(spark):
    known = op.known_digests()
    assert len({d for d, _ in known}) == len(known) and {i for _, i in known} == set(LICENSES) | set(NOTICES)
    with pytest.raises(ValueError):
        op.scan(documents(spark, ["x"]), known=[(str(i), "x") for i in range(op.MAX_KNOWN + 1)])


def test_long_text_repeats_null_ids_and_empty_table(spark):
    long = "line of prose\n" * 300_000 + "Licensed under CC BY-NC 4.0.\n"
    rows = spark.createDataFrame([(1, long), (2, "x"), (2, "Released under the MIT License."), (None, "Released under the MIT License.")],
                                 "doc_id long, text string")
    got = sorted((str(r.doc_id), r.license_notices) for r in op.scan(rows).collect())
    assert got == [("1", "CC-BY-NC-4.0"), ("2", "MIT"), ("2", "MIT"), ("None", None)]
    assert op.scan(rows.where("false")).collect() == []
    assert {r.license_notices for r in op.scan(rows, known=[]).collect()} == {None}


def test_usual_files_of_known_licenses(spark):
    c = "Copyright (c) 2021 Some One. All rights reserved.\n\n"
    texts = ["MIT License\n\n" + c + LICENSES["MIT"], "The MIT License (MIT)\n" + c + LICENSES["MIT"], c + LICENSES["BSD-2-Clause"],
             "ISC License\n\n" + c + LICENSES["ISC"], "zlib License\n\n" + c + LICENSES["Zlib"],
             "BSD 3-Clause License\n\n" + c + LICENSES["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "- "),
             "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + LICENSES["BSL-1.0"],
             LICENSES["Unlicense"].replace("http:", "https:"), "The Unlicense\n" + LICENSES["Unlicense"], "MIT License"]
    got = {r.doc_id: r.license_text for r in op.scan(documents(spark, texts)).collect()}
    assert got == dict(enumerate(["MIT", "MIT", "BSD-2-Clause", "ISC", "Zlib", "BSD-3-Clause", "BSL-1.0", "Unlicense", "Unlicense", None]))


def test_long_texts_and_further_digests(spark):
    rows = op.default_digests()
    assert len({d for d, _ in rows}) == len(rows) and {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= {i for _, i in rows}
    own = "Do what you like with it,\nbut never on Sundays."
    further = spark.createDataFrame([(op.digest(own), "Sunday-1.0"), (op.digest("Sunday licence applies."), "Sunday-1.0")], "digest string, license_id string")
    got = {r.doc_id: (r.license_text, r.license_notices)
           for r in op.scan(documents(spark, [own.upper(), "x\nSunday License applies", LICENSES["MIT"]]), further=further).collect()}
    assert got == {0: ("Sunday-1.0", None), 1: (None, "Sunday-1.0"), 2: ("MIT", None)}


def test_typographic_punctuation_and_holders_without_a_year(spark):
    mit, gpl = LICENSES["MIT"], "Copyright Notice\n"
    texts = [mit.replace('"AS IS"', "“AS IS”").replace(", ", " — "), "Copyright (c) <year> <copyright holders>\n\n" + mit,
             "MIT License\n\nCopyright Jane Doe\n" + mit, "COPYRIGHT: Jane Doe\ncopyright by jane doe\n" + mit, gpl + mit,
             "x\n" * 12 + "Copyright Jane Doe", mit + "\nCopyright Jane Doe"]
    got = {r.doc_id: r.license_text for r in op.scan(documents(spark, texts)).collect()}
    assert got == {0: "MIT", 1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: None}
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate([*texts, None, ""])))
    assert {r[0]: r[1] for r in con.execute(op.oracle_sql()).fetchall()} == {**got, 7: None, 8: None}
