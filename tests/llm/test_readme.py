"""The README's tables."""

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_every_operator_has_one_row_in_each_table():
    from tidemark.llm.queries import QUERIES

    text = open(os.path.join(ROOT, "README.md"), encoding="utf-8").read()
    operators, figures = text.split("## Training-data operators")[1].split("**Check figures**")
    for name in QUERIES:
        rows = [re.findall(rf"^\| `{name}` \| (.*)$", part, re.M) for part in (operators, figures)]
        assert [len(r) for r in rows] == [1, 1], name
        assert rows[0][0].startswith("`"), name
