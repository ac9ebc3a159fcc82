import duckdb
import pytest

from retailcast.llm import line_dedup as L
from retailcast.llm.queries import ORACLE_SQL, op10_line_dedup
from tests.conftest import SF0001
from tests.llm.conftest import frame


def plain(texts, least=10, keep_first=False):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    rows = [(t or "").split("\n") for t in texts]
    held = {}
    for i, lines in enumerate(rows):
        for p, line in enumerate(lines):
            held.setdefault(key(line), []).append((i, p))
    gone = {(i, p) for k, at in held.items() if k and len({i for i, _ in at}) >= least for i, p in (at[1:] if keep_first else at)}
    return [(len(r), sum((i, p) in gone for p in range(len(r))), "\n".join(x for p, x in enumerate(r) if (i, p) not in gone)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("keep_first", [False, True])
def test_matches_plain(spark, keep_first):
    texts = [f"Common line\n own {i} \n common LINE\t\n\n{'rare' if i < 9 else 'other'}\n" + "\n".join(f"l{i}-{k}" for k in range(200 if i == 3 else 2)) + "\nlast common" for i in range(14)]
    texts += ["", None, "common line", "\n", "Éa\néa"]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in L.dedup_lines(frame(spark, texts), keep_first=keep_first).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, keep_first=keep_first)


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF0001}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({ORACLE_SQL['op10_line_dedup']})").fetchall())
    assert sorted(map(tuple, op10_line_dedup(spark, SF0001).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())) == want


def test_odd_rows(odd_docs, no_docs):
    rows = L.dedup_lines(odd_docs, min_docs=2).collect()
    assert len(rows) == odd_docs.count() and L.dedup_lines(no_docs).count() == 0
    assert all(r["n_lines"] == 1 and r["kept"] == "" for r in rows if r["doc_id"] in (0, 1))


def test_no_python_in_the_plan(spark):
    plan = op10_line_dedup(spark, SF0001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
