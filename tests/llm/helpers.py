"""Fixtures in plain Python that several test modules share."""

WORD = rb"[^\x20\x09-\x0D]+"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that the operators use for themselves, to clash with.
CLASHING = ("_document", "uid", "score", "density", "key", "part", "node", "root", "_rank", "size", "target", "row", "n")


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, None, None)[:4] if len(r) < 4 else r for r in rows]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOC)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def same_rows(one, other):
    return sorted(map(tuple, one), key=repr) == sorted(map(tuple, other), key=repr)


def components(nodes, links):
    """Smallest node that each reaches."""
    least = {n: n for n in nodes}

    def find(n):
        while least[n] != n:
            n = least[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
