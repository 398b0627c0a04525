from tests.llm.rows import documents, edge_rows, prose
from visitlens.llm import licenses
from visitlens.llm.license_texts import TEMPLATES

VOCABULARY = frozenset(w for text in TEMPLATES.values() for w in licenses.words_of(text))


def test_every_template_is_found_in_the_middle_of_a_text():
    scanner = licenses.Scanner()
    for name, text in TEMPLATES.items():
        whole = prose(1, 30) + "\n" + text + "\n" + prose(2, 30)
        found = [scanner.examine(whole[a:b]) for a, b in licenses.blocks(whole, VOCABULARY)]
        assert [(f[0], f[3]) for f in found] == [(name, 0)], name


def test_wording_decides():
    scanner = licenses.Scanner()
    assert scanner.examine("Licensed under CC BY-NC 3.0.")[0] is None
    changed = scanner.examine(TEMPLATES["MIT"].replace("free of charge", "for a fee"))
    assert (changed[0], changed[3], changed[4]) == ("MIT", 3, "-free of charge+for a fee")
    assert scanner.examine("Copyright (c) 2024 A. B. Company. All rights reserved.")[:1] == ("Copyright",)


def test_the_winner_is_that_of_comparing_all_templates():
    every = licenses.Scanner(confirmed=len(TEMPLATES))
    first = licenses.Scanner()
    for text in [*TEMPLATES.values(), *(t.replace("the", "this", 2) for t in TEMPLATES.values()), "some permission is here", "licence"]:
        assert first.examine(text)[::3] == every.examine(text)[::3]


def test_awkward_rows(spark):
    notice = TEMPLATES["GPL-3.0-notice"]
    rows = [*edge_rows(), (60, f"{prose(1, 9)}\n{notice}\n\n{notice}\n{prose(2, 9)}"), (61, "a licence of some other kind")]
    found = licenses.scan(documents(spark, rows)).collect()
    got = sorted((r["doc_id"], r["block"], r["license"], r["n_diff"]) for r in found)
    assert got == [(60, 0, "GPL-3.0-notice", 0), (60, 1, "GPL-3.0-notice", 0), (61, 0, None, None)]
    assert all(dict(rows[-2:])[r["doc_id"]][r["first_char"]:r["last_char"]] for r in found)
    assert licenses.scan(documents(spark, [])).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    expected = sorted((r["doc_id"], name) for r in docs for line in r["text"].split("\n") for name, text in TEMPLATES.items() if line == text)
    found = licenses.op7_conditional_compression(spark, "/root/testdata/sf0.01").filter("license is not null").collect()
    assert set(expected) <= {(r["doc_id"], r["license"]) for r in found}


def published(name: str, marker: str) -> str:
    """The template in paragraphs of short lines, each behind a comment marker."""
    import re
    import textwrap

    paragraphs = re.split(r"(?<=conditions:) |(?<=Software\.) (?=THE)|(?<=copies\.) |(?<=met:) |(?<=License\.) |(?<=version\.) |(?= at http) |(?<=LICENSE-2\.0) |(?=[23]\. )",
                          " ".join(TEMPLATES[name].split()))
    assert len(paragraphs) > 1, name
    lines = [line for paragraph in paragraphs for line in (*textwrap.wrap(paragraph, 60), "")]
    return "\n".join((marker + line).rstrip() for line in lines)


def test_published_layouts_and_comment_markers(spark):
    names = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later"]
    wanted = [(name, marker) for name in names for marker in ("", "# ", " * ", "// ", ";; ")]
    rows = [(i, f"{prose(1, 30)}\n{published(*pair)}\n{prose(2, 30)}") for i, pair in enumerate(wanted)]
    got = licenses.scan(documents(spark, rows)).filter("license is not null").collect()
    assert sorted((r["doc_id"], r["license"], r["n_diff"]) for r in got) == [(i, name, 0) for i, (name, _) in enumerate(wanted)]


def test_every_licence_of_a_block_is_found(spark):
    names = ["MIT-notice", "CC-BY-4.0-notice", "GPL-2.0-notice", "GPL-3.0-notice", "LGPL-2.1-notice", "AGPL-3.0-notice", "MIT", "ISC", "MIT-notice"]
    rows = [(1, "Released under the MIT License.\nLicensed under CC BY 4.0."), (2, "\n".join(TEMPLATES[n] for n in names)),
            (3, "\n".join(["SPDX-License-Identifier: MIT", "Some other licence terms", "SPDX-License-Identifier: 0BSD"] * 400))]
    found = licenses.scan(documents(spark, rows)).orderBy("doc_id", "block").collect()
    assert [r["license"] for r in found if r["doc_id"] == 1] == ["MIT-notice", "CC-BY-4.0-notice"]
    assert [(r["block"], r["license"], r["n_diff"]) for r in found if r["doc_id"] == 2] == [(i, n, 0) for i, n in enumerate(names)]
    assert [r["license"] for r in found if r["doc_id"] == 3] == ["SPDX", None, "SPDX"] * 400
    texts = dict(rows)
    assert texts[1][found[1]["first_char"]:found[1]["last_char"]] == "Licensed under CC BY 4.0"
