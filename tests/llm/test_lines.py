import collections
import re

from waitband.llm import lines

from . import cases


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    cover = {i + k for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    own = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = n < 50 or 100 * len(cover) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(own) - len(set(own)), len(cover), failed


def test_base_counts(spark):
    docs = cases.documents(spark, ["a b c a b c", "x y z x y z " * 30, "l\nl\n\n \nl\nm", "a\x1cb\x85c d", "# * $%&|<>", " a 　", *["w%d " % (i % 7) * i for i in range(60)]])
    got = sorted(tuple(-1 if v is None else v for v in r[:7]) for r in lines.quality(docs).collect())
    assert got == sorted((-1 if r.doc_id is None else r.doc_id, *brute(r.text)) for r in docs.collect())
    assert lines.quality(cases.empty(spark)).count() == 0


def corpus():
    out = []
    for i in range(60):
        own = " ".join(chr(97 + i % 26) + chr(97 + i // 26) + chr(97 + k % 26) + chr(97 + k // 26) for k in range(60))
        out.append((i, f"Shared   Banner, number 7!\n{own}", "h" if i < 40 else "other"))
    body = "\n".join(" ".join(f"t{chr(97 + k)}{chr(97 + j)}" for j in range(14)) for k in range(8))
    out += [(100 + i, f"{body}\nunique {chr(97 + i % 26)}{chr(97 + i // 26)} tail", "h") for i in range(30)]
    out += [(200 + i, out[0][1], "h") for i in range(50)]  # copies are one document
    return out


def test_line_frequency_per_host(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    got = {r.doc_id: r for r in lines.quality(docs).collect()}
    assert all(got[i].kept for i in range(60))
    assert all(got[i].n_removed == 4 for i in range(60))
    assert not any(got[i].kept or got[i].base_failed for i in range(100, 130))
    assert all(got[200 + i].n_removed == 4 and got[200 + i].kept for i in range(50))


def test_clean_removes_only_those_lines(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.clean(docs).collect()}
    want = {i: t for i, t, _ in corpus()}
    assert all(got[i] == want[i].split("\n")[1] for i in range(60))
    assert all(got[i] == want[i].split("\n")[-1] for i in range(100, 130))


def test_a_line_of_few_documents_stays(spark):
    docs = spark.createDataFrame([(i, f"the very same line of words\nown text {chr(97 + i)}", "h") for i in range(lines.LEAST_DOCS)], "doc_id long, text string, source string")
    assert {r.n_removed for r in lines.quality(docs).collect()} == {0}
