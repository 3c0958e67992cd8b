"""Licence notices wrapped over lines, inside longer texts."""

import textwrap

import pytest

from cabrank.llm import licenses

NAMES = [name for name, _ in licenses.TEMPLATES]
LONG = [i for i, (_, t) in enumerate(licenses.TEMPLATES) if len(t) > 100]
CODE = "\n".join(f"value_{i} = compute(value_{i}, {i})" for i in range(60))
STYLES = ["{0}\n\n{1}", "#!/bin/sh\n# Copyright 2020 Some One\n#\n# {1}\n{0}", "{0}\n/* Copyright 2020 Some One.\n * {1}\n */\n{0}", "{0}\n{1}\n{0}"]


@pytest.fixture(scope="module")
def found(spark):
    rows = []
    for k in LONG:
        for j, style in enumerate(STYLES):
            mark = ["\n", "\n# ", "\n * ", "\n"][j]
            notice = mark.join(textwrap.wrap(licenses.TEMPLATES[k][1], [78, 60, 70, 30][j]))
            rows.append((k * 10 + j, style.format(CODE, notice)))
    rows += [(1000, CODE), (1001, "Released under\nthe MIT License.\n" + CODE), (1002, "Permission is hereby granted\n" + CODE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {(r.doc_id, r.license): (r.dice, r.n_units) for r in licenses.scan(docs).collect()}


@pytest.mark.parametrize("k", LONG)
def test_wrapped_notices_are_found(found, k):
    for j in range(len(STYLES)):
        dice, n = found[k * 10 + j, NAMES[k]]
        assert 0.8 <= dice <= 1 and n == 1


def test_a_wrapped_short_notice_and_nothing_else(found):
    assert found[1001, "MIT"] == (1.0, 1)
    assert not [key for key in found if key[0] in (1000, 1002)]
