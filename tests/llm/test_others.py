import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusproof.llm import outliers
from corpusproof.llm.licenses import RULES, license_matches
from corpusproof.llm.log_bilinear import lm_scores
from corpusproof.llm.mixing import document_rates, fit_rates, mixed
from corpusproof.llm.outliers import judged
from corpusproof.llm.queries import HOST_RULES
from corpusproof.llm.url_rules import judge_urls, mine_rules, url_tokens


def words(text, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


# ---- language model ----


def test_scores_and_counts(awkward, nothing):
    got = lm_scores(awkward, F.coalesce(F.col("doc_id") % 3 != 2, F.lit(False))).toPandas()
    rows = awkward.collect()
    counts, texts = Counter(), 0
    for r in rows:
        if r.doc_id is not None and r.doc_id % 3 != 2:
            counts.update(words(r.text, True))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1
    want = []
    for r in rows:
        own = words(r.text, True)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own) + math.log10((texts + 1) / (n + v + 1))
        want.append((r.doc_id or -1, len(own) + 1, sum(w in counts for w in own) + 1, n, round(base, 4)))
    have = [(-1 if math.isnan(r.doc_id) else int(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got.itertuples()]
    assert sorted(have) == sorted(want)
    assert (got.score < 0).all()
    assert lm_scores(nothing, F.lit(True)).count() == 0
    assert lm_scores(awkward, F.lit(False)).count() == len(rows)


def test_probabilities_sum_to_one():
    from corpusproof.llm.log_bilinear import CONTEXT, LogBilinear

    units = 700  # no square: the last class is not full
    model = LogBilinear.start(np.random.RandomState(1).randint(0, 50, units))
    context = np.random.RandomState(2).randint(0, units, (1, CONTEXT))
    total = np.exp(model.log_probabilities(np.repeat(context, units, 0), np.arange(units))).sum()
    assert abs(total - 1) < 1e-4


def test_training_beats_single_words(spark):
    draw = np.random.RandomState(0)
    rows = []
    for d in range(400):
        pair = ("red", "blue") if d % 2 else ("north", "south")
        rows.append((d, " ".join(draw.choice(pair, 60))))
    got = lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 300).where("doc_id >= 300").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b * 0.8


# ---- outliers ----


def test_statistics_and_verdicts(spark, awkward, nothing):
    draw = np.random.RandomState(1)
    vocabulary = ["stone", "river", "of", "the", "paper", "and", "walks", "answer", "blue", "seldom"] + [f"w{k}" for k in range(400)]
    clean = [(1000 + k, " ".join(draw.choice(vocabulary, 120)), "en", "s9", None, k) for k in range(200)]
    odd = [(2000 + k, " ".join(w + "$$$" for w in draw.choice(vocabulary, 120)), "en", "s9", None, k) for k in range(10)]
    table = awkward.union(spark.createDataFrame(clean + odd, awkward.schema))
    got = judged(table).collect()
    assert len(got) == table.count()
    by_id = Counter()
    for r in table.collect():
        own = words(r.text)
        runs = {}
        for k in range(len(own) - 2):
            runs.setdefault(tuple(own[k : k + 3]), []).append(k)
        twice = {j for at in runs.values() if len(at) > 1 for k in at for j in (k, k + 1, k + 2)}
        seen, again = set(), 0
        for line in (r.text or "").split("\n"):
            if words(line):
                again += line in seen
                seen.add(line)
        by_id[(r.doc_id, len(own), sum(map(len, own)), len(re.findall("[#*$%&|<>]", r.text or "")), again, len(twice), len(own) < 50 or 100 * len(twice) > 50 * len(own))] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == by_id
    kept = {r.doc_id for r in got if r.kept}
    assert not any(r.base_failed and r.kept for r in got)
    assert all(1000 + k in kept for k in range(200)) and not any(2000 + k in kept for k in range(10))
    assert judged(nothing).count() == 0


def test_each_statistic_rejects_alone(spark):
    """No other text of the group has symbols, upper case or repetition, so scatter is at its floor there."""
    draw = np.random.RandomState(2)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    lines = lambda n: [" ".join(draw.choice(vocabulary, 6)) for _ in range(n)]
    rows = [(k, "\n".join(lines(20))) for k in range(300)]
    repeated = lines(4)
    planted = {
        "long words": " ".join(w * 2 for w in draw.choice(vocabulary, 120)),
        "symbols": "\n".join(x + " #" for x in lines(20)),
        "upper case": "\n".join(x.title() for x in lines(20)),
        "lines": "\n".join([*lines(20), *["bal dem"] * 20]),
        "words": " ".join(" ".join(x) for x in [lines(11), repeated, lines(1), repeated, lines(1)]),
        "a third of lines and words": "\n".join([*lines(14), *repeated[:3], *repeated[:3]]),
    }
    table = spark.createDataFrame(rows + [(1000 + k, t) for k, t in enumerate(planted.values())], "doc_id long, text string")
    got = {r.doc_id: r for r in judged(table).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[k].kept for k in range(300))
    assert [name for k, name in enumerate(planted) if got[1000 + k].kept] == []


def plain_mcd(groups, floor, support, settled, median):
    """Squared distances of the rows of each group, by concentration steps over whole arrays."""
    at = lambda x, q: np.sort(x, axis=0)[math.ceil(q * len(x)) - 1]
    far = lambda x, c, inverse: np.einsum("ni,ij,nj->n", x - c, inverse, x - c)
    state = {}
    for g, x in groups.items():
        centre = at(x, 0.5)
        for start, scale in enumerate([np.maximum(at(np.abs(x - centre), 0.5) * 1.4826, floor), 3 * floor]):
            state[g, start] = [centre, np.diag(1 / scale**2), 0.0, math.inf]
    moving = True
    while moving:
        moving = False
        for (g, _), s in state.items():
            d2 = far(groups[g], s[0], s[1])
            near = groups[g][d2 <= at(d2, support)]
            scatter = (near.T @ near / len(near) - np.outer(near.mean(0), near.mean(0))) / np.outer(floor, floor)
            values, vectors = np.linalg.eigh(scatter)
            scatter = vectors @ np.diag(np.maximum(values, 1)) @ vectors.T * np.outer(floor, floor)
            s[:3] = near.mean(0), np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1]
            moving |= s[3] - s[2] > settled
            s[3] = min(s[3], s[2])
    found = {}
    for g, x in groups.items():
        best = min((state[g, k] for k in (0, 1)), key=lambda s: s[2])
        d2 = far(x, best[0], best[1])
        found[g] = d2 / max(1, at(d2, 0.5) / median)
    return found


def test_verdicts_of_groups_of_any_size(spark):
    """Groups of one row up to 150 are each judged by their own estimate, as a plain computation has it."""
    draw = np.random.RandomState(4)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows = []
    for size in (1, 2, 3, 5, 9, 59, 60, 61, 150):
        for k in range(size):
            text = list(draw.choice(vocabulary, draw.randint(50, 200)))
            if k % 7 == 3:
                text = [w + "#" * draw.randint(0, 3) for w in text]
            if k % 11 == 5:
                text = [w.upper() if draw.rand() < 0.4 else w for w in text]
            rows.append((1000 * size + k, " ".join(text), None if size == 9 else "en", f"s{size}"))
    rows.append((7, "short text", "en", "s150"))
    got = judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).toPandas().set_index("doc_id")
    texts = {r[0]: r[1] for r in rows}
    fine = got[~got.base_failed]
    upper = np.array([sum(c.isupper() for c in texts[d]) for d in fine.index])
    lines = np.array([texts[d].count("\n") + 1 for d in fine.index])
    x = np.stack([np.log(fine.word_chars / fine.n_words), np.log1p(100 * fine.n_symbols / fine.word_chars), upper / fine.word_chars, np.sqrt(fine.n_dup_lines / lines), np.sqrt(fine.n_repeat_words / fine.n_words)], axis=1)
    groups = {g: x[(fine.source == g).to_numpy()] for g in fine.source.unique()}
    want = plain_mcd(groups, np.array(outliers.FLOOR), outliers.SUPPORT, outliers.SETTLED, 4.351)
    for g in groups:
        own = fine[fine.source == g]
        assert np.allclose(own.distance2, want[g], rtol=1e-6, atol=1e-6), g
        assert (own.kept == (want[g] <= outliers.CUTOFF)).all()
    assert not got.loc[7].kept and got.loc[[1000, 2000, 2001]].kept.all()
    assert (~fine.kept).sum() > 10 and fine.kept.mean() > 0.6


# ---- URLs ----


def test_hosts_paths_rules_and_mined_rules(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?q=1#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://example.net/fr/", "example.net", "/fr/", "net/", "block"),
        (3, "https://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
        (4, "https://m.example.com/de/1", "m.example.com", "/de/1", "example.com/de/", "block"),
        (5, "https://x.org/fr/1", "x.org", "/fr/1", "org/fr/", "allow"),
        (6, "no scheme", "", "", None, "allow"),
        (7, None, "", "", None, "allow"),
        (8, "ftp://host.net", "host.net", "", None, "allow"),
        (9, "x://a?b/c", "a", "", None, "allow"),
        (10, "http://spam.win.example.com/offer/1", "spam.win.example.com", "/offer/1", None, "block"),
        (10, "http://spam.win.example.com/offer/1", "spam.win.example.com", "/offer/1", None, "block"),
    ]
    pages = spark.createDataFrame([(r[0], r[1], "clash") for r in rows], "page_id long, url string, verdict string")
    labelled = spark.createDataFrame([(f"http://h{k}.win.example.com/offer/{k}", True) for k in range(20)] + [(f"http://h{k}.example.com/story/{k}", False) for k in range(60)] + [(None, True), ("http://z.com/", None)], "url string, blocked boolean")
    got = judge_urls(pages, labelled, HOST_RULES)
    assert sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in got.collect()) == sorted((r[0], r[2], r[3], r[4] or "", r[5]) for r in rows)
    assert judge_urls(pages.limit(0), labelled, HOST_RULES).count() == 0
    assert judge_urls(pages, labelled.limit(0), HOST_RULES).where("mined is not null").count() == 0


def test_mined_rules_against_enumerated_sets(spark):
    import itertools

    rng = random.Random(6)
    hosts, paths = ["a.example.com", "b.example.org", "c.shop.io"], ["offer", "news", "win", "story"]
    urls = []
    for k in range(400):
        host, path = rng.choice(hosts), rng.sample(paths, 2)
        bad = ("win" in path and host.startswith("c.")) or "offer" in path
        urls.append((f"http://{host}/{path[0]}/{path[1]}/{k}", bad if rng.random() < 0.9 else not bad))
    tokens = spark.createDataFrame(urls, "url string, blocked boolean").select(url_tokens(F.col("url")).alias("t"), "blocked").collect()
    baskets = [(frozenset(r.t), r.blocked) for r in tokens]
    names, least, confidence = sorted(set().union(*(b for b, _ in baskets))), 8, 0.6
    rules = {}
    for size in range(1, 9):
        for part in map(frozenset, itertools.combinations(names, size)):
            have = [bad for b, bad in baskets if part <= b]
            if sum(have) >= least and sum(have) / len(have) >= confidence:
                rules[part] = (sum(have), sum(have) / len(have))
    kept = {p: v for p, v in rules.items() if not any(q < p and rules[q][1] >= v[1] for q in rules)}
    got = {frozenset(r.tokens): (r.n, r.confidence) for r in mine_rules(spark.createDataFrame(urls, "url string, blocked boolean"), 0.001, confidence, least).collect()}
    assert got.keys() == kept.keys() and kept
    assert all(got[p][0] == kept[p][0] and abs(got[p][1] - kept[p][1]) < 1e-9 for p in kept)


# ---- licenses ----


def notice(name, n=0):
    return [text for license, text in RULES if license == name][n]


def test_rules_need_their_sentences_in_order(spark, awkward, nothing):
    mit = [" ".join(p.split()) for p in re.split(r"(?<=[.:])\s+", notice("mit", 2)) if p]
    docs = [
        (1, "Some text.\nReleased under the MIT License.\nMore. All rights\nreserved."),
        (2, "Intro\n\n" + " ".join(mit).replace(" the ", "\nthe ", 3)),
        (3, "\n".join([mit[1], mit[0], mit[2], mit[3]])),
        (4, "\n".join([mit[0], "One.", "Two.", mit[1], mit[2], mit[3]])),
        (5, "\n".join([mit[0], *(f"Other {k}." for k in range(9)), *mit[1:]])),
        (6, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."),
        (7, "This is no licensed thing."),
    ]
    got = license_matches(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.times) for r in got if r.license != "mit-0") == [(1, "all-rights-reserved", 1), (1, "mit", 1), (2, "mit", 1), (4, "mit", 1), (6, "cc-by-nc-4.0", 2)]
    assert license_matches(awkward).count() == 0 and license_matches(nothing).count() == 0
    own = license_matches(spark.createDataFrame([(1, "Do what you like. But be kind to it."), (2, "But be kind to it. Do what you like.")], "doc_id long, text string"), [("kind", "Do what you like. But be kind to it.")])
    assert [(r.doc_id, r.license, r.rule) for r in own.collect()] == [(1, "kind", 0)]


def test_standard_notices_in_comments_and_wrapped(spark):
    import textwrap

    docs, want = [], {}
    for k, (name, text) in enumerate(RULES):
        parts = [textwrap.wrap(" ".join(p.split()), 70) for p in text.split("\n\n")]
        lines = [line for p in parts for line in [*p, ""]]
        leader = ["# ", " * ", "// ", ""][k % 4]
        head = f"{leader}Copyright (c) 2020 Some One\n{leader.rstrip()}\n"
        docs.append((k, "code before\n\n" + head + "\n".join((leader + line).rstrip() for line in lines) + "\ncode after"))
        want[k] = name
    got = {}
    for r in license_matches(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert {k: v for k, v in want.items() if v not in got.get(k, ())} == {}
    # and nothing but notices that are part of it, or word for word the same
    allowed = {"mit": {"mit-0"}, "bsd-3-clause": {"bsd-2-clause"}}
    assert {k: got[k] - {want[k]} - allowed.get(want[k], set()) for k in got if got[k] - {want[k]} - allowed.get(want[k], set())} == {}


def test_every_notice_sentence_has_a_sign(spark):
    from corpusproof.llm.licenses import SIGNS, sentences_of

    texts = spark.createDataFrame([(t,) for _, t in RULES], "text string").select(sentences_of(F.col("text"), False).alias("s")).collect()
    assert all(any(any(sign in s for sign in SIGNS) for s in r.s) for r in texts)


# ---- mixing ----


@pytest.fixture(scope="module")
def two_domains(spark):
    draw = np.random.RandomState(3)
    kinds = {"sea": ["wave", "salt", "boat", "tide"], "hill": ["stone", "goat", "pine", "path"]}
    rows = [(k, " ".join(draw.choice(kinds["sea" if k % 4 else "hill"], draw.randint(5, 60)))) for k in range(400)]
    labels = spark.createDataFrame([(k, "sea" if k % 4 else "hill") for k in range(0, 400, 2)] + [(1, "hill")] + [(None, "sea")], "doc_id long, domain string")
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def least_squares(a, wanted, weight):
    """The least (a r - wanted)' weight (a r - wanted) over r >= 0, for two rows in ``a``: some best r has at most two entries."""
    worth = lambda gap: np.einsum("in,ij,jn->n", gap, weight, gap)
    one = np.maximum(0, (a.T @ weight @ wanted) / worth(a))
    best = min(worth(-wanted[:, None])[0], worth(a * one - wanted[:, None]).min())
    i, j = np.triu_indices(a.shape[1], 1)
    det = a[0, i] * a[1, j] - a[0, j] * a[1, i]
    with np.errstate(divide="ignore", invalid="ignore"):
        x, y = (wanted[0] * a[1, j] - wanted[1] * a[0, j]) / det, (wanted[1] * a[0, i] - wanted[0] * a[1, i]) / det
    return 0.0 if ((x >= 0) & (y >= 0) & (np.abs(det) > 1e-12)).any() else best


@pytest.mark.parametrize("targets, close", [({"sea": 0.5, "hill": 0.5}, 1e-5), ({"sea": 0.05, "hill": 0.95}, 1e-5), ({"sea": 1.0}, 1e-3), ({"hill": 1.0}, 1e-3)])
def test_rates_against_least_squares(spark, two_domains, targets, close):
    """The fit's own sums are worked out anew from its rows; what it leaves is compared with what any rates must leave.

    Where a domain is to vanish the fit stops short of the best rates, which put all words on very few documents: it leaves
    up to ``close`` of the target's own worth, in words of that domain.
    """
    docs, labels = two_domains
    fit = fit_rates(docs, labels, targets, total=30_000)
    rows = fit.rows.toPandas()
    a = np.stack(rows.p.map(np.array)).T * rows.n_words.to_numpy()
    wanted = 30_000 * np.array([targets.get(d, 0) for d in fit.domains])
    reached = a @ rows.rate.to_numpy()
    assert len(rows) == 400 and (rows.rate >= 0).all() and rows.n_words.sum() == sum(len(words(r.text)) for r in docs.collect())
    assert np.allclose(reached, fit.reached) and np.allclose(wanted, fit.wanted) and np.allclose(a.sum(1), fit.had)
    p = a / rows.n_words.to_numpy()
    weight = np.linalg.inv(a @ p.T)
    gap = reached - wanted
    least, scale = least_squares(a, wanted, weight), wanted @ weight @ wanted
    assert least * (1 - 1e-9) <= gap @ weight @ gap <= least + close * scale


def test_totals_meet_targets(spark, two_domains, awkward, nothing):
    docs, labels = two_domains
    rated = document_rates(docs, labels, {"sea": 0.5, "hill": 0.5}).toPandas()
    share = (rated.n_words * rated.rate)[rated.domain == "hill"].sum() / (rated.n_words * rated.rate).sum()
    assert abs(share - 0.5) < 0.05 and (rated.rate >= 0).all()
    assert abs((rated.n_words * rated.rate).sum() / rated.n_words.sum() - 1) < 0.02
    copies = mixed(docs, labels, {"sea": 0.5, "hill": 0.5}).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    for targets in ({"sea": 0.2, "hill": 0.8}, {"sea": 9, "hill": 1}):  # a domain may have to grow several times
        fit = fit_rates(docs, labels, targets)
        assert max(map(abs, fit.gaps().values())) <= 1e-3, fit
    missed = fit_rates(docs, labels, {"sea": 0.5, "lake": 0.5})
    assert missed.domains == ["hill", "sea"] and missed.wanted[0] == 0  # a domain without labels is not in the mix
    both = rated.set_index("doc_id").rate
    assert all(abs(copies.get(d, 0) - r) < 1 for d, r in both.items())
    odd = document_rates(awkward, labels, {"sea": 1.0})
    assert odd.columns[: len(awkward.columns)] == awkward.columns and odd.count() == awkward.count()
    assert document_rates(nothing, labels, {"sea": 1.0}).count() == 0
    assert document_rates(docs, labels.limit(0), {"sea": 1.0}).select("rate").distinct().count() == 1


def test_a_null_id_counts_as_an_empty_string(spark):
    from corpusproof.llm.queries import held_out

    rows = spark.createDataFrame([(None,), (3,)], "doc_id long").select(held_out("doc_id", 5, 0).alias("a"), held_out("doc_id", 7, 2).alias("b")).collect()
    assert tuple(rows[0]) == (True, False) and None not in rows[1]


def test_removal_leaves_what_another_thread_makes(spark):
    import os
    import threading

    from corpusproof.llm.components import connected_components
    from corpusproof.llm.scratch import removed, written

    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a long, b long")
    other = []
    with removed(spark):
        thread = threading.Thread(target=lambda: other.append(written(spark.range(3), "other")))
        thread.start()
        thread.join()
        found = connected_components(edges)
        assert {tuple(r) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
        own = found._scratch_path.removeprefix("file://")
        assert os.path.isdir(own)
    assert not os.path.exists(own) and other[0].count() == 3
