"""URL templates, personal data, mixing and exact dedup against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from livetables.llm import exact_dedup, mixing, pii, url_filter
from livetables.llm.queries import SOURCE_WEIGHTS, URL_RULES

# --- URL templates ---------------------------------------------------------

URLS = [None, "", "no scheme", "http://A.Example.COM/en/1?x#y", "https://www.example.com/en/2", "http://example.com", "http://a.net/es/3",
        "http://net/fr/", "http://net/frx", "x://b.net?es/", "http://b.net#/es/1", "http://c.org/en/4/5/6/7/8/9", "http://xnet/es/1",
        "http://com/", "http://É.com/en/", "a://b://c.com/x", "http://u@h.com:80/p q", "http://example.com/en", "http://d.org//a//"]


def plain_url(url):
    m = re.search("://", url or "")
    rest = url[m.end():] if m else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *(best or (None, None))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")


def test_hosts_paths_and_rules(spark):
    rows = url_filter.judge_urls(pages(spark, URLS + URLS), URL_RULES).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, verdict = plain_url((URLS + URLS)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_templates_take_the_labels_of_their_branch(spark):
    rules = [("x.org", "/bad/1", "block"), ("x.org", "/good/1", "allow")]
    urls = [f"http://x.org/{d}/{i}" for d in ("bad", "good") for i in range(1, 60)]
    urls += [f"http://x.org/new/{i}" for i in range(20)] + [f"http://y.org/bad/{i}" for i in range(20)]
    got = {urls[r.page_id]: r for r in url_filter.judge_urls(pages(spark, urls), rules).collect()}
    assert got["http://x.org/bad/2"].verdict == "block" and got["http://x.org/bad/2"].template == "/bad/*"
    assert got["http://x.org/good/2"].verdict == "allow"
    assert got["http://x.org/new/2"].verdict == "allow"          # no label reaches a branch without one
    assert got["http://y.org/bad/2"].verdict == "allow"          # templates are a host's own


def test_branches_alike_are_merged(spark):
    rules = [("x.org", "/a/", "block"), ("x.org", "/b/", "block"), ("x.org", "/c/", "allow")]
    urls = [f"http://x.org/{d}/{i}" for d in "abc" for i in range(30)]
    got = {r.template for r in url_filter.judge_urls(pages(spark, urls), rules, z=3.0).where("path like '/a/%' or path like '/b/%'").collect()}
    assert len(got) <= 2
    only = [u for u in urls if "/c/" not in u]
    got = {r.template for r in url_filter.judge_urls(pages(spark, only), rules).collect()}
    assert got == {"/*/*"}


def test_unlabelled_branches_join_the_labelled_ones_they_are_like(spark):
    rules = [("x.org", "/es/", "block"), ("x.org", "/fr/", "block"), ("z.org", "/es/", "allow")]
    urls = [f"http://x.org/{d}/{i}" for d in ("es", "fr", "en") for i in range(20)] + ["http://x.org/de/7"]
    urls += [f"http://x.org/docs/guide/{d}.html" for d in "abcdefg"] + [f"http://x.org/v2/{i}" for i in range(6)]
    urls += [f"http://z.org/{d}/{i}" for d in ("es", "en") for i in range(20)] + [f"http://y.org/en/{i}" for i in range(20)]
    got = {urls[r.page_id]: r for r in url_filter.judge_urls(pages(spark, urls), rules).collect()}
    for url in ("http://x.org/en/3", "http://x.org/de/7"):
        assert (got[url].rule, got[url].template, got[url].verdict) == (None, "/*/*", "block")
        assert got[url].purity == pytest.approx((40 + 4.0 * 0.2) / (40 + 4.0))
    assert got["http://x.org/docs/guide/a.html"].verdict == "allow"      # other shapes follow
    assert got["http://x.org/v2/1"].verdict == "allow"                   # another shape
    assert got["http://z.org/en/3"].template == "/*/*" and got["http://z.org/en/3"].verdict == "allow"
    assert got["http://y.org/en/3"].verdict == "allow"                   # labels stay on their host


def test_no_pages(spark):
    assert url_filter.judge_urls(pages(spark, []), URL_RULES).count() == 0


# --- personal data ---------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in span.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


TEXTS = [None, "", "é🎉 mail a.b@c.de, x@y and a@b.c_d@e.f, q@@r.s.t", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 1.2.3 99999999999.1.1.1",
         "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111234 0000000000000", "+1 (988) 555-2485 +1-2 +12345678901234567 + 1",
         "call (212) 555-0199 or 212-555-0199; mail bob (at) example (dot) com; password=hunter22", "a" * 50_000 + "@b.c", "1" * 60_000,
         "1 " * 30_000, "a." * 20_000 + "@x.y", "x@" + "a." * 20_000 + "b", "+1" + "(" * 30_000 + "2", "4111 1111 1111 1111" * 3]


def people(spark, texts):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, kind int")


def test_base_spans_equal_plain_regexes(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice(["a", "@", ".", "1", "25", " ", "-", "+", "(", ")", "é", "_", "4111", "b.c", "\n"]) for _ in range(80)) for _ in range(300)]
    texts = TEXTS + made
    for r in pii.personal_data(people(spark, texts)).collect():
        got = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base]
        assert got == base_spans(texts[r.doc_id]), texts[r.doc_id]


def test_the_method_adds_spans_and_keeps_base_ones(spark):
    texts = [f"contact: user{i}@mail.com, phone: (212) 555-01{i % 90 + 10}, password=abc{i}defg" for i in range(40)]
    rows = pii.personal_data(people(spark, texts)).collect()
    for r in rows:
        kinds = {(s.kind, s.base) for s in r.spans}
        assert ("email", True) in kinds and ("phone", False) in kinds and ("credential", False) in kinds
        order = [(pii.KINDS.index(s.kind), s.start) for s in r.spans]
        assert order == sorted(order)
    assert pii.personal_data(people(spark, [])).count() == 0


def test_em_trusts_the_labeler_that_agrees():
    counts = [((1, 1, None), 400), ((0, 0, None), 400), ((1, 1, 0), 50), ((1, 1, 1), 50), ((0, 0, 1), 50), ((0, 0, 0), 50)]
    post = dict(zip([v for v, _ in counts], pii.fit_em(counts)))
    assert post[(1, 1, 0)] > 0.9 and post[(0, 0, 1)] < 0.1


def test_the_regex_labeler_judges_the_span_not_its_origin(spark):
    texts = ["a.b@mail.com .x@mail.com bob (at) mail (dot) com", "10.1.2.3 001.2.3.4 2001:db8:1:2:3:4:5:6",
             "4111 1111 1111 1111; 4111.1111.1111.1111; 4111.1111.1111.1112", "+1 (988) 555-2485; (826) 555-4081; (126) 555-4081"]
    rows = pii.candidates(people(spark, texts), "doc_id", "text").orderBy("id").collect()
    votes = [sorted(((s.start, s.base, s.v_regex) for s in r.spans)) for r in rows]
    assert [[v[1:] for v in line] for line in votes] == [
        [(True, 1), (True, 0), (False, None)], [(True, 1), (True, 0), (False, None)],
        [(True, 1), (False, 1), (False, 0)], [(True, 1), (False, None), (False, 0)]]


def test_more_of_the_same_texts_give_the_same_spans(spark):
    texts = [f"tel: +1 (988) 555-2{i:03}" if i % 3 else f"+44 20 7946 0{i:03}" for i in range(157)]
    texts += ["see (826) 555-4081", "ask (826) 555-4082 there"] + [f"call (212) 555-01{i}" for i in range(10, 20)] + ["order no (212) 555-0177"] * 3
    found = pii.candidates(people(spark, texts), "doc_id", "text").persist()
    once, patterns = pii.fit(found), [((1, 1, 1), 100), ((1, 1, None), 55), ((1, 0, 0), 2), ((None, 1, None), 2), ((None, 1, 0), 3)]
    for times in (10, 100, 300):
        many = pii.fit(found.crossJoin(spark.range(times)))
        assert all(many[k] == pytest.approx(once[k]) for k in once)
        assert pii.fit_em([(v, n * times) for v, n in patterns]) == pytest.approx(pii.fit_em(patterns))
    few, ten = ({r.doc_id: [tuple(s)[:4] for s in r.spans] for r in pii.personal_data(df).collect()}
                for df in (people(spark, texts), people(spark, texts).crossJoin(spark.range(10)).drop("id")))
    assert few == ten
    assert all(few[i] for i in range(169))                     # the loose numbers are reported, cue or not


# --- mixing ----------------------------------------------------------------

def water_level(sizes, weights, most):
    """Targets by plain filling: raise the level until the budget is spent."""
    budget, open_, target = float(sum(sizes.values())), set(sizes), {}
    while True:
        left, w = budget - sum(target.values()), sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * left / w > most * sizes[s] + 1e-9} if w else set()
        if not full:
            return {**target, **{s: weights[s] * left / w for s in open_}}
        for s in full:
            target[s] = float(most * sizes[s])
        open_ -= full


def test_mix_meets_its_targets(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 97 == 0 else " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))),
             rng.choice(["a", "a", "a", "b", "c", "d", None, "é"]), 1) for i in range(1500)]
    rows += [(2000, "one two\x0bthree\u00a0four", "tiny", 1), rows[5], (None, "x y", "b", 1), (None, "x y", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.schedule(df, SOURCE_WEIGHTS).select("row.*", F.col("size").alias("words"), "source_size", "target", F.size("finish").alias("n")).collect()
    assert len(got) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    targets = water_level(sizes, {s: SOURCE_WEIGHTS[i % 3] for i, s in enumerate(order)}, 3)
    taken = {}
    for r in got:
        assert r.words == words(r.text) and r.source_size == sizes[r.source] and 0 <= r.n <= 3
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.words * r.n
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 31
    mixed = mixing.mix(df, SOURCE_WEIGHTS)
    assert mixed.columns == df.columns and mixed.count() == sum(r.n for r in got)
    again = mixing.schedule(df.repartition(7), SOURCE_WEIGHTS).select("row.doc_id", F.size("finish").alias("n")).collect()
    assert sorted((str(r.doc_id), r.n) for r in again) == sorted((str(r.doc_id), r.n) for r in got)


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df, SOURCE_WEIGHTS).count() == 0
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert mixing.mix(df, SOURCE_WEIGHTS).count() == 0
    assert mixing.schedule(df, SOURCE_WEIGHTS).count() == 2


# --- exact dedup -----------------------------------------------------------

COPIES = [(1, "a", "x"), (2, "a", "y"), (3, None, "x"), (4, "", "x"), (5, "b", "x"), (5, "b", "x"), (None, "b", "x"), (None, "c", "x"),
          (6, "z" * 100_000, "x"), (7, "z" * 100_000, "x"), (8, "a ", "x")]


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("content_hash", [exact_dedup.md5_128, lambda t: F.substring(F.md5(t.cast("binary")), 1, 1), lambda t: F.lit("same")])
def test_groups_equal_plain_python(spark, keep, content_hash):
    df = spark.createDataFrame([(*r, "k") for r in COPIES], "doc_id long, text string, h string, keep_id string")
    got = exact_dedup.exact_groups(df, keep=keep, content_hash=content_hash).collect()
    groups = {}
    for i, t, _ in COPIES:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t, _ in COPIES:
        ids = [x for x in groups[t or ""] if x is not None]
        best = {"min": min, "max": max}[keep](ids) if ids else None
        want.append((i, best, len(groups[t or ""]), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_one_row_of_each_text_stays(spark):
    df = spark.createDataFrame([(*r, "k") for r in COPIES], "doc_id long, text string, h string, sha string")
    kept = exact_dedup.keep_rows(df, keep="max")
    assert kept.columns == df.columns
    assert sorted(((r.text or "")[:3], r.doc_id) for r in kept.collect() if r.doc_id) == [("", 4), ("a", 2), ("a ", 8), ("b", 5), ("zzz", 7)]
    assert sorted((r.text or "")[:3] for r in kept.collect()) == ["", "a", "a ", "b", "c", "zzz"]
    assert exact_dedup.keep_rows(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_and_text_give_one_row_whatever_their_order(spark):
    rows = [(5, "q", f"source{i}") for i in range(6)] + [(None, "z", "a"), (None, "z", "b"), (None, "z", None)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
        found.add(tuple(sorted(map(tuple, exact_dedup.keep_rows(df).collect()), key=repr)))
    assert len(found) == 1 and sorted(r[1] for r in found.pop()) == ["q", "z"]


def test_credentials_in_quotes_and_very_long_ones(spark):
    import random as r
    rng = r.Random(1)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in [40] * 60 + [200, 5000]]
    forms = ['token = "{}"', "api_key: '{}'", "mein Passwort={}", "contraseña = {}"]
    texts = ["x. " + forms[i % 4].format(h) + " und so weiter" for i, h in enumerate(hexes)]
    texts += ['token = "required"', "token: none", "password = example_example", "das Passwort: geheimnis und mehr", "no token here"] * 3
    rows = {x.doc_id: x.spans for x in pii.personal_data(people(spark, texts)).collect()}
    for i, h in enumerate(hexes):
        found = [texts[i][s.start:s.end] for s in rows[i] if s.kind == "credential"]
        assert len(found) == 1 and h in found[0], (texts[i][:80], found)
    assert not any(s.kind == "credential" for i in range(len(hexes), len(texts)) for s in rows[i])


def test_registered_query_finds_the_tables_credentials(spark):
    from livetables.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    texts = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{d}/documents.parquet").collect()}
    holds = {i for i, t in texts.items() if re.search(r'token = "[0-9a-f]{20,}"', t)}
    found = {x.doc_id for x in QUERIES["op2_pii_weak_supervision"](spark, d).collect() if "credential" in x.spans}
    assert len(holds) > 5 and len(holds & found) >= 0.9 * len(holds) and len(found - holds) <= 2


def test_em_equals_a_plain_version_on_rows():
    """EM on counted vote patterns against the same steps over one entry per span."""
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        real = rng.random() < 0.4
        rows.append(tuple(None if rng.random() < 0.2 else int(rng.random() < (p if real else q)) for p, q in ((0.9, 0.1), (0.7, 0.2), (0.8, 0.4), (0.6, 0.3))))
    counts = {}
    for x in rows:
        counts[x] = counts.get(x, 0) + 1
    post = dict(zip(counts, pii.fit_em(list(counts.items()))))
    unit, hit, false, prior = pii.SMOOTHING * len(rows), [0.8] * 4, [0.3] * 4, 0.5
    for _ in range(50):
        own = []
        for x in rows:
            a, b = prior, 1 - prior
            for j, v in enumerate(x):
                if v is not None:
                    a *= hit[j] if v else 1 - hit[j]
                    b *= false[j] if v else 1 - false[j]
            own.append(a / (a + b))
        prior = (sum(own) + unit) / (len(rows) + 2 * unit)
        for j in range(4):
            for table, share, ahead in ((hit, own, 0.8), (false, [1 - p for p in own], 0.3)):
                table[j] = ((sum(w for w, x in zip(share, rows) if x[j] == 1) + 4 * unit * ahead)
                            / (sum(w for w, x in zip(share, rows) if x[j] is not None) + 4 * unit))
    assert all(abs(post[x] - p) < 1e-9 for x, p in zip(rows, own))
