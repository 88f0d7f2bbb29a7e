from webloom.llm.licences import LICENCES, scan

MIT = next(t for i, t in LICENCES if t.startswith("Permission is hereby granted"))


def test_variants_of_a_licence_match_and_others_do_not(spark):
    variants = [
        (1, "MIT License", None), (2, MIT, "MIT"), (3, "Copyright (c) 2020 Some One\n\n" + MIT.upper(), "MIT"),
        (4, "MIT Licence\n" + MIT.replace(", ", " ").replace("sublicense", "sub-licence"), "MIT"), (5, MIT + " Not.", None),
        (6, "Licensed under the Apache License, Version 2.0.", "Apache-2.0"), (7, None, None), (8, "", None), (9, "?!", None),
        (10, "prose\nReleased under the MIT licence\nLicensed under CC BY-NC 4.0", None), (11, "© 2021 X. All rights reserved", None),
    ]
    df = spark.createDataFrame([(i, t, "d", "l") for i, t, _ in variants], "doc_id long, text string, digest string, lines string")
    got = {r.doc_id: r for r in scan(df).collect()}
    assert {i: got[i].license_id for i in got} == {i: x for i, _, x in variants}
    assert got[10].notices == "CC-BY-NC-4.0,MIT" and got[6].notices == "Apache-2.0" and got[8].notices == ""


def test_messy_rows_and_empty_table(messy, rows, nothing):
    assert scan(messy).count() == len(rows)
    assert scan(messy).where("license_id is not null or notices <> ''").count() == 0
    assert scan(nothing).collect() == []


def test_rows_that_repeat_an_id_are_told_apart(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License."), (1, "something else entirely")], "doc_id long, text string")
    assert sorted((r.license_id or "", r.notices) for r in scan(df).collect()) == [("", ""), ("MIT", "MIT")]


def test_given_licences_replace_the_known_ones(spark):
    from webloom.llm.licences import known_licences
    df = spark.createDataFrame([(1, "My terms, 1999"), (2, MIT)], "doc_id long, text string")
    got = scan(df, known_licences(spark, [("own", "my TERMS 1999")]))
    assert {r.doc_id: r.license_id for r in got.collect()} == {1: "own", 2: None}
