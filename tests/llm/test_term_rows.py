"""Rows that the counting of terms hands on."""

import pytest


def test_term_counts_are_handed_on_column_by_column():
    pytest.importorskip("pandas")
    import pandas as pd

    from tidemark.llm import source_audit as A

    texts = pd.DataFrame({"lang": ["a", "a", ""], "source": ["s", "s", "t"], "_text": ["Été x X y", "x 1 x", " 1 "]})
    out = pd.concat(A._counted(iter([texts])))
    found = {(r.lang, r.source, r.term): (r.n, r.docs) for r in out.itertuples()}
    assert found == {("a", "s", "Été"): (1, 1), ("a", "s", "x"): (3, 2), ("a", "s", "x\u2003y"): (1, 1)}
    assert out["n"].dtype == "int64" and out["docs"].dtype == "int64"
