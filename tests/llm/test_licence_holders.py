import textwrap

import pytest
from webloom.llm.licences import LICENCES, scan

MIT = next(t for i, t in LICENCES if t.startswith("Permission is hereby granted"))
BSD = next(t for i, t in LICENCES if i == "BSD-3-Clause" and t.startswith("Redistribution"))
HOLDERS = [
    "Copyright Jane Doe 2019", "© Jane Doe 2019", "Portions Copyright (c) 2010 X", "Copyright by X, 2011",
    "Copyright Jane Doe and contributors", "Copyright OpenJS Foundation and other contributors",
    "# Copyright Jane Doe. All rights reserved.", "(c) Jane Doe 2019",
]


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.license_id for r in scan(df).orderBy("doc_id").collect()]


def test_holder_lines_are_no_part_of_a_licence(spark):
    assert found(spark, [f"{x}\n\n{MIT}" for x in HOLDERS]) == ["MIT"] * len(HOLDERS)


def test_terms_that_begin_a_line_stay(spark):
    lines = ["copyright notice, this list of conditions", "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "(c) You must retain the form",
             "Copyright law applies", "copyright and related or neighboring rights"]
    assert found(spark, [f"{x}\n\n{MIT}" for x in lines]) == [None] * len(lines)


@pytest.mark.parametrize("width", [40, 60, 72, 79])
def test_wrapped_texts_with_other_spellings_match(spark, width):
    bsd = BSD.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR")
    wrap = lambda t: "\n".join(textwrap.fill(x, width, break_on_hyphens=True) for x in t.split("\n"))
    texts = [wrap(bsd), bsd.replace("COPYRIGHT OWNER", "COPYRIGHT\nOWNER"), bsd.replace("COPYRIGHT OWNER", "COPYRIGHT  OWNER"),
             wrap(MIT.replace("sublicense", "sub-license")), MIT.replace("sublicense", "sub-\nlicense")]
    assert found(spark, texts) == ["BSD-3-Clause"] * 3 + ["MIT"] * 2
