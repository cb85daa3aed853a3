import pytest

from carelake.llm import licenses


@pytest.fixture(scope="module")
def model(spark, sf):
    return licenses.fit(spark.read.parquet(f"{sf}/documents.parquet"))


def test_scan_matches_brute_force(spark, sf, model):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {(r.doc_id, r.paragraph): r.license for r in licenses.scan(docs, model).where("paragraph is not null").collect()}
    for d in docs.collect():
        for i, line in enumerate(d.text.split("\n")):
            assert found.get((d.doc_id, i)) == licenses.brute_force(model, line)
    lines = {line for d in docs.collect() for line in d.text.split("\n")}
    assert {licenses.brute_force(model, x) for x in lines if "Licensed under the Apache License, Version 2.0." == x} <= {"Apache-2.0"}


def test_held_out_notices(model):
    """Wordings that the training set does not have."""
    for line, family in [("This library is released under the MIT License", "MIT"),
                         ("Code licensed under the Apache License, Version 2.0, by us", "Apache-2.0"),
                         ("It is licensed under the GNU General Public License, version 3", "GPL-3.0"),
                         ("Text licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"), ("All rights reserved", "proprietary"),
                         ("Licensed under the Foo Bar Licence.", "unknown"), ("The house is on the hill.", None), ("", None)]:
        assert licenses.brute_force(model, line) == family, line


def test_odd_rows(spark, odd_docs, no_docs, model):
    got = licenses.per_document(licenses.scan(odd_docs, model)).collect()
    assert len(got) == odd_docs.count() and {r.licenses for r in got} == {""}
    assert sorted(r.n_paragraphs for r in got)[:4] == [0, 0, 0, 0]
    assert licenses.per_document(licenses.scan(no_docs, model)).count() == 0
    rows = [(1, "Released under the MIT License.\nx\nAll rights reserved.")] * 2 + [(None, "All rights reserved.")]
    twice = licenses.per_document(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model)).collect()
    assert sorted(r.licenses for r in twice) == ["MIT,proprietary", "MIT,proprietary", "proprietary"]


def test_fit_without_background(no_docs):
    m = licenses.fit(no_docs)
    assert licenses.brute_force(m, "Released under the MIT License.") == "MIT"


def test_no_python_in_the_plan(odd_docs, model):
    plan = licenses.per_document(licenses.scan(odd_docs, model))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_sibling_licences_are_not_confirmed(spark, model):
    """One differing word pair is enough, however like the rest of the template is."""
    lines = ["Under the GNU General Public License, version 2", "Under the GNU Lesser General Public License, version 3",
             "Under the GNU Affero General Public License, version 3", "Licensed under CC BY-SA 4.0.",
             "Licensed under CC BY-NC-ND 4.0.", "Licensed under CC BY-NC-SA 4.0.",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
             "This work is licensed under a Creative Commons Attribution 3.0 International License."]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.per_document(licenses.scan(docs, model)).collect()}
    assert got == dict.fromkeys(range(len(lines)), "unknown")
    assert [licenses.brute_force(model, x) for x in lines] == ["unknown"] * len(lines)


def test_every_notice_of_a_family_is_confirmed(model):
    for family in licenses.FAMILIES:
        for notice in licenses.NOTICES[family]:
            assert licenses.brute_force(model, notice) == family, notice
    assert all(marks for family, _, marks, _ in licenses.templates() if family != "unknown")


MIT_HEADER = """\
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:"""
GPL_HEADER = """\
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_wrapped_notices(spark, model):
    texts = [f"/*\n{MIT_HEADER}\n */\nint main();", f"{GPL_HEADER}\n#\nimport os", f"some words\n{GPL_HEADER}\nother words",
             f"{GPL_HEADER.replace('General', 'Lesser General')}", f"All rights reserved.\n{GPL_HEADER}",
             f"{GPL_HEADER}\n\n{GPL_HEADER}", "Licensed under the Apache\nLicense, Version 2.0.",
             "Licensed under the Apache\n\nLicense, Version 2.0.", "Released under the\nMIT License.\n" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(docs, model)
    got = {r.doc_id: (r.n_licenses, r.licenses) for r in licenses.per_document(found).collect()}
    assert got[0] == (1, "MIT") and got[1] == (1, "GPL-3.0") and got[2] == (1, "GPL-3.0")
    assert "GPL-3.0" not in got[3][1] and got[4] == (2, "GPL-3.0,proprietary") and got[5] == (2, "GPL-3.0")
    assert got[6] == (1, "Apache-2.0") and "Apache-2.0" not in got[7][1] and got[8] == (40, "MIT")
    assert [r.paragraph in (1, 2) for r in found.where("doc_id = 2 and confirmed").collect()] == [True]


def test_notices_are_found_wherever_their_lines_break(spark, model):
    texts, want = [], []
    for family in licenses.FAMILIES:
        for notice in licenses.NOTICES[family]:
            words = notice.split(" ")
            if len(words) > 3:
                for width in (1, *range(3, len(words) + 1)):
                    texts.append("\n".join("# " + " ".join(words[i:i + width]) for i in range(0, len(words), width)))
                    want.append(family)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_licenses, r.licenses) for r in licenses.per_document(licenses.scan(docs, model)).collect()}
    assert {t: got[i] for i, t in enumerate(texts) if got[i] != (1, want[i])} == {}


def test_clauses_and_identifiers(spark, model):
    two = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that "
           "the following conditions\nare met:")
    three = ("Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote "
             "products derived from\nthis software without specific prior written permission.")
    texts = [two, f"{two}\n\n{three}", "// SPDX-License-Identifier: MIT\nint x;", "# SPDX-License-Identifier: Apache-2.0",
             "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: ISC", "SPDX-License-Identifier: GPL-2.0-only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.per_document(licenses.scan(docs, model)).collect()}
    assert "BSD-3-Clause" not in got[0] and "BSD-3-Clause" in got[1]
    assert [got[i] for i in range(2, 7)] == ["MIT", "Apache-2.0", "GPL-3.0", "unknown", "unknown"]
