from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from rosterlake.config import MergeConfig, NormalizationConfig, QualityConfig, SourceConfig
from rosterlake.functions import html as H
from rosterlake.functions import text as T
from rosterlake.functions.similarity import ratio
from rosterlake.operators import clean, fuzzy, match, signature
from rosterlake.storage import number_rows, number_within


def test_dedup_golden(spark):
    rows = [("A  b", None, "c1", 0), ("a B", None, "c2", 1), ("a b", "2000-01-01", "c3", 2), ("A b", None, "c1", 3)]
    df = spark.createDataFrame(rows, "name string, born string, category string, _row_ord long").withColumn("_src_ord", F.lit(0))
    out = clean.deduplicate(df, MergeConfig(["name", "born", "absent"], "first", ["category"])).orderBy("_row_ord").collect()
    assert [(r["name"], r["born"], r["category"]) for r in out] == [("A  b", None, "c1; c2"), ("a b", "2000-01-01", "c3")]
    again = clean.deduplicate(clean.deduplicate(df, MergeConfig(["name", "born"])), MergeConfig(["name", "born"]))
    assert again.count() == 2
    empty = df.withColumn("category", F.lit(None).cast("string"))
    assert {r["category"] for r in clean.deduplicate(empty, MergeConfig(["name"], "first", ["category"])).collect()} == {""}


def test_mapping_and_constants(spark):
    df = spark.createDataFrame([(" x ", "-", "7"), ("n/a", "", "8")], "a string, b string, c string")
    out = clean.clean_source(df, SourceConfig("s", "csv", "", {"missing": "m", "b": "second", "a": "first"}, {"constants": {"second": " k "}}))
    assert out.columns == ["second", "first", "m", "source"]
    assert [tuple(r) for r in out.collect()] == [(" k ", "x", None, "s")]
    assert clean.combine([]) is None


def test_drop_if_matches(spark):
    df = spark.createDataFrame([("Х исключена в связи",), ("Х ИСКЛЮЧЕНО",), ("Х исключены",), (None,)], "v string")
    kept = clean.quality_filter(df, QualityConfig(drop_if_matches={"v": r"исключен[ао]\b"}))
    assert [r["v"] for r in kept.collect()] == ["Х исключены", None]


def test_normalize_skips_missing_columns(spark):
    df = spark.createDataFrame([("01.02.2020", "77-1")], "d string, i string")
    out = clean.normalize_columns(df, NormalizationConfig(date_fields=["d", "x"], id_fields=["i"], text_fields=["i", "y"], uppercase_fields=["z"]))
    assert tuple(out.first()) == ("2020-02-01", "771")


def test_kitten():
    assert round(ratio("KITTENS", "KITTEN"), 1) == 92.3
    rng = random.Random(5)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        assert abs(ratio(a, b) - 200 * row[-1] / (len(a) + len(b))) < 1e-9


def test_fuzzy_against_all_pairs(spark):
    rng = random.Random(7)
    names = ["ALPHA BETA GAMMA", "DELTA EPSILON", "ZETAZETA", "OMICRON PI RHO", "ALPHA BETA GAMMAS"]

    def typo(s):
        i = rng.randrange(len(s))
        return s[:i] + rng.choice(["", "X", s[i] + "Y"]) + s[i + 1 :]

    texts = [(k, " ".join(" ".join(typo(rng.choice(names)) if rng.random() < 0.7 else rng.choice(names) for _ in range(4)).split())) for k in range(25)]
    patterns = spark.createDataFrame([(n, n, "", "org", "", i) for i, n in enumerate(names)], match.PATTERN)
    df = spark.createDataFrame(texts, "k long, norm_text string")
    exact = match.find_exact(df, patterns, "k")
    found = {(r["k"], r["norm"]): r["score"] for r in fuzzy.find_fuzzy(df, patterns, exact, "k", 88, 8, 5).collect()}
    known = {(r["k"], r["norm"]) for r in exact.collect()}
    want = {}
    for k, text in texts:
        tokens = text.split(" ")
        for size in range(1, 4):
            for i in range(len(tokens) - size + 1):
                w = " ".join(tokens[i : i + size])
                if len(w) < 8:
                    continue
                score, nth = max((ratio(w, n), -j) for j, n in enumerate(names))
                n = names[-nth]
                if score >= 88 and n != w and (k, n) not in known:
                    want[k, n] = max(want.get((k, n), 0), score)
    assert found == {x: round(s, 1) for x, s in want.items()}


def test_near_windows_of_many_patterns():
    rng = random.Random(11)
    for threshold in (90, 88, 70.5):
        letters = "АBC D"
        norms = [*{"".join(rng.choice(letters) for _ in range(rng.randint(4, 26))) for _ in range(150)}, "AB CD " * 20]
        windows = []
        for _ in range(400):
            w = list(rng.choice(norms))
            for _ in range(rng.randint(0, 5)):
                i = rng.randrange(len(w) + 1)
                w[i : i + 1] = rng.choice(["", rng.choice(letters), "Ю" + "".join(w[i : i + 1])])
            windows.append("".join(w))
        length = np.array([len(w) for w in windows])
        codes = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32)
        index = fuzzy.Index(norms, threshold)
        compared, scores = [], index.scores
        index.scores = lambda *a: compared.append(len(a[-1])) or scores(*a)
        found = {w: (n, s) for w, n, s in zip(*(x.tolist() for x in index.near(codes, np.cumsum(length) - length, length)), strict=True)}
        best = {i: max((ratio(w, n), -j) for j, n in enumerate(norms)) for i, w in enumerate(windows)}
        assert found == {i: (-j, s) for i, (s, j) in best.items() if s >= threshold}
        assert threshold < 88 or sum(compared) < len(windows) * len(norms) / 50


def test_fuzzy_in_blocks_of_patterns(spark, monkeypatch):
    names = ["ALPHA BETA GAMMA", "ALPHA BETA GAMMAS", "DELTA EPSILON", "OMICRON PI RHO"]
    patterns = spark.createDataFrame([(n, n, "", "org", "", i) for i, n in enumerate(names)], match.PATTERN)
    texts = ["", "X ALPHA BETTA GAMMA DELTA EPSILON DELTTA EPSILON", "OMICRONPI RHO ALPHA BETA GAMMAX", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, norm_text string")
    exact = match.find_exact(df, patterns, "k")
    one = sorted(tuple(r) for r in fuzzy.find_fuzzy(df, patterns, exact, "k").collect())
    monkeypatch.setattr(fuzzy, "BLOCK", 1)
    assert one == sorted(tuple(r) for r in fuzzy.find_fuzzy(df, patterns, exact, "k").collect())
    assert [r[:3] + (r[4],) for r in one] == [(1, "ALPHA BETA GAMMA", "ALPHA BETTA GAMMA", 3), (2, "ALPHA BETA GAMMA", "ALPHA BETA GAMMAX", 15), (2, "OMICRON PI RHO", "OMICRONPI RHO", 1)]


def test_find_exact_shared_first_words(spark):
    names = ["A", "A B", "A B C", "A B C D", "A B C E", "B C"]
    patterns = spark.createDataFrame([(n, n, "", "org", "", i) for i, n in enumerate(names)], match.PATTERN)
    texts = spark.createDataFrame([(1, "A B C D A"), (2, "A B"), (3, "")], "k long, norm_text string")
    found = sorted((r["k"], r["start_token"], r["norm"]) for r in match.find_exact(texts, patterns, "k").collect())
    assert found == [(1, 0, "A"), (1, 0, "A B"), (1, 0, "A B C"), (1, 0, "A B C D"), (1, 1, "B C"), (1, 4, "A"), (2, 0, "A"), (2, 0, "A B")]


def test_findings_order(spark):
    values = ["низкая (возможен тёзка)", "высокая", "нечёткое совпадение (91.0%)", "средняя"]
    rows = [(f"e{i}", "b" if i == 0 else "a", c, "u", "", "", i) for i, c in enumerate(values)]
    df = spark.createDataFrame(rows, "entity string, category string, confidence string, page_url string, page_title string, context string, at int")
    out = match.findings_table(df, ["at"]).orderBy("id").collect()
    assert [r["sushchnost"] for r in out] == ["e1", "e3", "e2", "e0"]
    assert match.findings_table(df.limit(0), ["at"]).columns == ["id", *match.FINDING_COLUMNS.values()]


def test_context(spark):
    df = spark.createDataFrame([("say «Тест-Ёж», twice", "ТЕСТ ЕЖ"), ("say «Тест-Еж», twice", "ТЕСТ ЕЖ"), ("x" * 100 + " abc  def " + "y" * 100, "ABC DEF"), ("nothing", "ABC"), ("a", "")], "t string, n string")
    got = [r[0] for r in df.select(T.extract_context(F.col("t"), F.col("n"))).collect()]
    assert got == ["", "…say «Тест-Еж», twice…", "…" + "x" * 79 + " abc def " + "y" * 79 + "…", "", ""]


def test_html():
    title, text, links = H.extract_visible('<title> T </title><script>var a="</p><a href=no>";</script><p>one<p>two<img alt=pic><a href="/x" title=tip>go</a><!-- c -->')
    assert title == "T" and links == ["/x"] and "one two" in text and text.endswith("/x pic tip") and "var" not in text
    assert [n.text() for n in H.select(H.parse("<ul class='a b'><li>1<li>2</ul><li>3"), "ul.a > li")] == ["1", "2"]
    assert H.tables("<table><tr><td>a<td>b<tr><td>c</table>") == [[["a", "b"], ["c"]]]
    assert H.extract_visible(None) == ("", "  ", [])


def test_signature_is_free_of_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "i int, v string")
    one = signature.content_signature(df)
    assert one == signature.content_signature(df.orderBy(F.col("i").desc()))
    assert one != signature.content_signature(df.unionAll(df.limit(1)))
    assert signature.content_signature(df.limit(0)) != one


def test_statuses(spark):
    of = lambda df: signature.sums_signature(df).first()["signature"]
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, v string")
    one, two = of(df), of(df.unionAll(df.limit(1)))
    assert one == of(df.orderBy(F.col("i").desc())) and one != two and of(df.limit(0))["count"] == "0"
    signed = "name string, method string, signature map<string,string>, error string"
    current = spark.createDataFrame([("a", "content", one, None), ("b", "content", one, None), ("c", "content", one, None), ("d", "http_headers", {"etag": "1"}, None), ("e", "error", None, "no"), ("f", "content", one, None)], signed)
    baseline = spark.createDataFrame([("b", one), ("c", two), ("d", {"etag": None}), ("e", one), ("f", {"count": "2", "hash": "0123"})], "name string, signature map<string,string>")
    found = {r["name"]: r["status"] for r in signature.statuses(current, baseline).collect()}
    assert found == {"a": "new", "b": "unchanged", "c": "changed", "d": "changed", "e": "error", "f": "new"}


def test_dates(spark):
    given = ["05.06.24", "31/12/99", "2020/03/04", "2020/31/12", "5-Mar-2021", "05-March-2021", "99.99.99", "2020"]
    df = spark.createDataFrame([(x,) for x in given], "d string")
    assert [r[0] for r in df.select(T.normalize_date("d")).collect()] == ["2024-06-05", "1999-12-31", "2020-04-03", "2020-12-31", "2021-03-05", "2021-03-05", "99.99.99", "2020"]


def test_number_rows(spark):
    df = spark.range(1000).repartition(7).withColumnRenamed("id", "v")
    got = number_rows(df, [F.col("v").desc()]).collect()
    assert sorted((r["id"], r["v"]) for r in got) == [(i + 1, 999 - i) for i in range(1000)]


def test_number_within(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).withColumn("k", F.when(F.col("k") > 0, F.lit(7)).cast("long")).repartition(6)
    got = sorted(((r["k"] or 0), r["v"], r["n"]) for r in number_within(df, "k", [F.col("v").desc()], "n").collect())
    want = []
    for k, values in ((0, [v for v in range(500) if v % 3 == 0]), (7, [v for v in range(500) if v % 3])):
        want += [(k, v, i + 1) for i, v in enumerate(sorted(values, reverse=True))]
    assert got == sorted(want)


def test_exact_beyond_the_broadcast(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "A B C A B"), (2, ""), (3, "B")], "k long, norm_text string")
    rows = spark.createDataFrame([(n, n, "", "org", "", i) for i, n in enumerate(("A B", "B", "B C A"))], match.PATTERN)
    one = sorted(tuple(r) for r in match.find_exact(texts, rows, "k").collect())
    monkeypatch.setattr(match, "BROADCAST_PATTERNS", 0)
    assert one == sorted(tuple(r) for r in match.find_exact(texts, rows, "k").collect()) and len(one) == 6
