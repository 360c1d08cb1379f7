import hashlib
import re

from orderlake.llm import fill_middle as M
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents, edge_rows

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by slicing a list of units."""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(df, rows):
    got = df.withColumn("back", M.restore(df["output"], df["form"])).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
                   for r in got), key=str) == sorted(((i is None, i, *by_hand(i, t)) for i, t in rows), key=str)
    assert sorted(r["back"] for r in got) == sorted(t for _, t in rows)


def test_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_fill_middle"](spark, SF_SMALL).collect()}
    for i, text, _ in documents(SF_SMALL):
        n, form, p, m, out = by_hand(i, text.decode())
        assert got[i] == (n, form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
    assert {f for _, f, *_ in got.values()} == {"plain", "psm", "spm"}


def test_edges(spark, edge_docs, no_docs):
    check(M.transform(edge_docs), [(i, t or "") for i, t, _ in edge_rows()])
    assert M.transform(no_docs).count() == 0


def test_odd_texts_and_clashing_columns(spark):
    texts = ["a<S", "<", "x <P> y", "a <b> c", "> a", "$1 \\2 ${x}", "\x1c   é 日本 \U0001F600 z", " lead", "tail \n\n", "\n",
             "<P", "P> <M", "q\x00r s", "(a|b)* [c]{3} \\E x"]
    rows = [(i, t) for t in texts for i in range(30)]
    df = spark.createDataFrame([(i, t, 1, "f", "o") for i, t in rows], "doc_id long, text string, N int, form string, output string")
    check(M.transform(df), rows)


def test_long_texts_do_not_recurse(spark):
    long = [(i, ("word ü" * 300_000 + " ") if i % 2 else " " * 400_000 + "x " * 400_000) for i in (1, 2, 3, 4)]
    check(M.transform(spark.createDataFrame(long, "doc_id long, text string"), rate=50), long)


def test_string_ids(spark):
    check(M.transform(spark.createDataFrame([("a", "one two three"), ("ü", "x y z")], "doc_id string, text string")),
          [("a", "one two three"), ("ü", "x y z")])
