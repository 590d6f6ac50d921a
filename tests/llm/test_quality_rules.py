import re
from collections import Counter

from sparkmart.llm import quality_rules


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", s)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_equal_brute_force(docs, rows):
    got = [(r.doc_id, *[r[c] for c in COUNTS]) for r in quality_rules.counts(docs).collect()]
    want = [(r[0], *brute(r[1])) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repeated_windows_overlap_and_ties(spark):
    texts = ["a b c a b c", "x x x x", "x x x", "a b c d a b c d a b c", "a\x0bb\x0cc a b c\n\n a|b<c> #"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in quality_rules.counts(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_bad_texts_go_and_good_ones_stay(spark):
    good = [(i, "the " + " ".join(f"w{i}x{j} of" for j in range(60))) for i in range(60)]
    bad = [(100 + i, " ".join(f"W{i}X{j}***" for j in range(80))) for i in range(12)]
    out = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()}
    assert all(out[i].kept for i, _ in good) and not any(out[i].kept for i, _ in bad)
    assert all(0 <= r.quality <= 1 for r in out.values())


def test_windows_of_many_words_keep_their_places(spark):
    words = [f"w{i}" for i in range(5_000)]
    text = " ".join(words + words[100:103] + ["x"] * 4 + words[4_990:] + words[:2])
    df = spark.createDataFrame([(1, text), (2, text + " " + text)], "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in quality_rules.counts(df).collect()}
    assert got == {1: brute(text), 2: brute(text + " " + text)}


def plain_em(patterns, rounds):
    """EM over single documents: posteriors of the last round's rates."""
    n, rules = len(patterns), len(patterns[0])
    start, prior = quality_rules.START, quality_rules.PRIOR * len(patterns)
    share, rate = 0.8, [{v: start[v] for v in start} for _ in range(rules)]

    def posterior(p):
        good, bad = share, 1 - share
        for x, v in enumerate(p):
            good, bad = good * rate[x][v][0], bad * rate[x][v][1]
        return good / (good + bad)
    for _ in range(rounds):
        g = [posterior(p) for p in patterns]
        share = sum(g) / n
        rate = [{v: ((prior * start[v][0] + sum(a for a, p in zip(g, patterns) if p[x] == v)) / (sum(g) + prior),
                     (prior * start[v][1] + sum(1 - a for a, p in zip(g, patterns) if p[x] == v)) / (n - sum(g) + prior))
                 for v in start} for x in range(rules)]
    return [posterior(p) for p in patterns]


def test_quality_equals_plain_em(spark):
    good = [f"the {i} " + " ".join(f"w{i}x{j} of" for j in range(20 + i)) for i in range(40)]
    bad = [" ".join(f"W{i}X{j}***" for j in range(40 + i)) for i in range(10)] + ["a b c d " * 30, "", "!! ? !"]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    named = quality_rules.rules()
    votes = {r.doc_id: tuple(r[x] for x in named) for r in
             quality_rules.counts(df).select("doc_id", *[named[x].alias(x) for x in named]).collect()}
    want = dict(zip(votes, plain_em(list(votes.values()), quality_rules.EM_ROUNDS)))
    got = quality_rules.judged(df).collect()
    assert all(abs(r.quality - want[r.doc_id]) < 1e-9 for r in got)
    assert all(r.kept == (not r.base_failed and r.quality >= 0.5) for r in got)


def test_query_over_the_whole_table(spark, tmp_path, docs, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = quality_rules.op4_quality_rules(spark, str(tmp_path))
    assert out.columns[:8] == ["doc_id", *COUNTS, "base_failed", "kept"]
    got = out.collect()
    assert sorted(((r.doc_id, *[r[c] for c in COUNTS]) for r in got), key=repr) == sorted(
        ((r[0], *brute(r[1])) for r in rows), key=repr)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)


def test_no_python_in_the_plan(docs):
    for df in (quality_rules.counts(docs), quality_rules.judged(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(no_docs):
    assert quality_rules.judged(no_docs).count() == 0
