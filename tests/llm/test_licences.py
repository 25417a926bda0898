"""The licence classifier on documents it was not trained on."""

import textwrap

from tripgrid.llm import licences

DOCS = "/root/testdata/sf0.1/documents.parquet"

# The notices in the generated documents.
NOTICES = {
    "MIT": "Released under the MIT License",
    "Apache": "Licensed under the Apache License",
    "GPL": "GNU General Public License",
    "CC BY-NC": "Licensed under CC BY-NC",
}


def test_held_out_documents(spark):
    df = spark.read.parquet(DOCS)
    model = licences.train(licences.sample_paragraphs(df))
    out = {r.doc_id: set(r.families) for r in licences.scan_licences(df, model).collect()}
    wrong = [r.doc_id for r in df.collect() if out[r.doc_id] != {k for k, v in NOTICES.items() if v in r.text}]
    assert len(wrong) <= 0.001 * len(out)


def test_variants_unknowns_and_odd_rows(spark):
    model = licences.train(["Some plain words about nothing.", "The work of others is free."] * 50)
    texts = {
        1: ("hello\nDistributed under the MIT License\n\n more", ["MIT"]),
        2: ("licensed under the gnu general public license, version 2", ["GPL"]),
        3: ("Licensed under CC BY-SA 3.0.\nLicensed under the BSD 3-Clause License.", ["BSD", "CC BY-SA"]),
        4: ("My driving license is new.", []),
        5: (None, []),
        6: (" \n\t\n", []),
        7: ("word " * 100_000 + "\nReleased under the MIT License.", ["MIT"]),
    }
    rows = [(i, t, "clash", 1) for i, (t, _) in texts.items()] + [(None, "Released under the MIT License.", "c", 1), (4, "My driving license is new.", "c", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, families string, n_notices int")
    out = licences.scan_licences(df, model).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.families == (texts[r.doc_id][1] if r.doc_id else ["MIT"])
        assert r.n_confirmed <= r.n_notices <= r.n_paragraphs
    assert {r.doc_id: r.n_paragraphs for r in out}[1] == 3 and {r.doc_id: r.n_paragraphs for r in out}[6] == 0
    assert licences.scan_licences(df.where("false"), model).count() == 0
    assert licences.train([]).scan(b"Released under the MIT License.") == (1, [(0, True)])


def test_sample_does_not_depend_on_order_or_partitions_and_is_bounded(spark):
    df = spark.read.parquet(DOCS).select("doc_id", "text")
    odd = spark.createDataFrame([(-1, "x" * 3_000_000), (-2, None), (-3, "\n".join(["one line again and again"] * 5000))], "doc_id bigint, text string")
    df = df.unionByName(odd)
    one = licences.sample_paragraphs(df)
    assert one == licences.sample_paragraphs(df.orderBy("text").repartition(13))
    assert len(one) == len(set(one)) == licences.SAMPLE_ROWS
    assert max(map(len, one)) <= licences.SAMPLE_CHARS
    assert licences.sample_paragraphs(df.where("false")) == []


def wrapped(text, width, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def confirmed(model, text):
    return [licences.FAMILIES[f] for f, sure in model.scan(text.encode())[1] if sure]


PLAIN = ["Some plain words about nothing.", "The work of others is free.", "A day at the sea with all of us and the dog."] * 40


def test_wrapped_notices_and_headings():
    model = licences.train(PLAIN)
    for family, templates in licences.TEMPLATES.items():
        for template in templates:
            for width in (40, 60, 72):
                for mark in ("", "# ", " * "):
                    text = "int x;\n\n" + wrapped(f"Copyright 2020 by the authors. {template} and so on.", width, mark) + "\n\nint y;"
                    assert confirmed(model, text) == [family], text
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by"
    assert confirmed(model, gpl) == ["GPL"]
    for family, headings in licences.HEADINGS.items():
        for heading in headings:
            assert confirmed(model, f"a\n\n   {heading.upper()}\n\nb") == [family]
    assert confirmed(model, "They teach the GNU General Public License and other licences to all students of law.") == []
    assert confirmed(model, "Permission is hereby granted,\n\nfree of charge\n\nto any person\n\nobtaining a copy") == []  # blank lines part


def test_notices_within_long_lines():
    model = licences.train(PLAIN)
    plain = " ".join(PLAIN).split()
    for family, templates in licences.TEMPLATES.items():
        for k, template in enumerate(templates):
            before, after = " ".join(plain[: 700 + k]), " ".join((plain * 6)[:4300])
            assert confirmed(model, f"{before} {template} {after}") == [family], template
    both = f"{' '.join(plain)} Released under the MIT License. {' '.join(plain)} Licensed under CC BY-SA 4.0. {' '.join(plain)}"
    assert sorted(confirmed(model, both)) == ["CC BY-SA", "MIT"]
    assert model.scan(" ".join(plain * 6).encode()) == (1, [])
