"""Language, toxicity and language-model scoring: small exact cases and held-out accuracy."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import language_id, lm_score, toxicity
from tests.conftest import SMOKE_DIR
from tests.llm import frames

MIDDLE_DIR = SMOKE_DIR.replace("0.001", "0.01")


def test_language_backoff_order():
    model = language_id.Model(["a", "b"], {"known": 0}, np.array([[1.0, -1.0]]),
                              {"<zebr": 0, "ze": 1, "q": 2}, np.array([[-3.0, 3.0], [5.0, -5.0], [2.0, -2.0]]))
    assert model.scores("known").tolist() == [1.0, -1.0]
    assert model.scores("zebra").tolist() == [-3.0, 3.0]  # the longest known n-gram speaks alone
    assert model.scores("zest").tolist() == [5.0, -5.0]
    assert model.scores("iq").tolist() == [2.0, -2.0]
    assert model.scores("xx").tolist() == [0.0, 0.0]


def test_language_edge_cases(spark):
    rows = [(i, "the house and the river", "en") for i in range(20)] + [(100 + i, "das haus und der fluss", "de") for i in range(20)]
    odd = [(200, None), (201, ""), (202, "123 -- !"), (203, "the RIVER"), (204, "FLUSS haus " * 20000), (205, "日本"),
           (None, "das haus"), (203, "the RIVER")]
    model = language_id.fit(frames.docs(spark, rows))
    df = frames.docs(spark, odd)
    got = language_id.predict(df, model)
    assert got.columns == [c for c in df.columns if c != "score"] + ["lang_pred", "score"]
    found = {(r.doc_id, r.text): r for r in got.collect()}
    assert got.count() == len(odd)
    assert [found[k].lang_pred for k in ((200, None), (201, ""), (202, "123 -- !"))] == ["und"] * 3
    assert found[203, "the RIVER"].lang_pred == "en" and found[None, "das haus"].lang_pred == "de"
    assert found[204, "FLUSS haus " * 20000].lang_pred == "de" and found[205, "日本"].lang_pred in ("de", "en")
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language_id.predict(frames.docs(spark, []), model).count() == 0
    none = language_id.fit(frames.docs(spark, []))
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}


def brute_languages(labelled, texts, grams=(5, 4, 3, 2, 1)):
    """The back-off rule stated over plain counts: (language, share) of each text."""
    letters = lambda t: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
    langs = sorted({lang for _, lang in labelled if lang})
    pieces = lambda w, n: [f"<{w}>"[i:i + n] for i in range(len(w) + 3 - n)] if n > 1 else list(w)
    words = {k: Counter() for k in langs}
    parts = {k: Counter() for k in langs}
    for text, lang in labelled:
        for w in letters(text) if lang else ():
            words[lang][w] += 1
            parts[lang].update(g for n in grams for g in pieces(w, n))

    def logs(table, item):
        size = len({x for k in langs for x in table[k]})
        own = [math.log(table[k][item] + 0.5) - math.log(sum(table[k].values()) + 0.5 * max(1, size)) for k in langs]
        return [x - sum(own) / len(own) for x in own]

    def of(w):
        if any(words[k][w] for k in langs):
            return logs(words, w)
        for n in grams:
            known = [logs(parts, g) for g in pieces(w, n) if any(parts[k][g] for k in langs)]
            if known:
                return [sum(x) / len(known) for x in zip(*known, strict=True)]
        return [0.0] * len(langs)

    out = []
    for text in texts:
        found = [of(w) for w in letters(text)]
        total = [sum(x) for x in zip(*found, strict=True)]
        if not total:
            out.append(("und", 0.0))
            continue
        best = max(range(len(langs)), key=lambda k: (total[k], -k))
        out.append((langs[best], 1 / sum(math.exp(x - total[best]) for x in total)))
    return out


def test_language_equals_brute_force(spark):
    rng = random.Random(2)
    sound = {"aa": ["ba", "ka", "lo", "mi"], "bb": ["ka", "zu", "pre", "lo"], "cc": ["ñe", "mi", "zu", "ö"]}
    make = lambda lang, n: " ".join("".join(rng.choices(sound[lang], k=rng.randrange(1, 4))) for _ in range(n))
    labelled = [(make(lang, 9), lang) for lang in sound for _ in range(8)] + [("ba ba", None), (None, "aa"), ("ka", "")]
    texts = [make(rng.choice(list(sound)), rng.randrange(1, 5)) for _ in range(40)]
    texts += [None, "", "½", "² ①", "ka½zu", "¿MI-ka?", "qqq", "ⅷ 一", "Ⅷ", "x²"]
    model = language_id.fit(frames.docs(spark, [(k, t, lang) for k, (t, lang) in enumerate(labelled)]))
    got = {r.doc_id: r for r in language_id.predict(frames.docs(spark, list(enumerate(texts))), model).collect()}
    for k, (lang, share) in enumerate(brute_languages([(t, x) for t, x in labelled if t and x], texts)):
        assert math.isclose(got[k].score, share, rel_tol=1e-9), texts[k]
        assert got[k].lang_pred == lang or math.isclose(share, 1 / 3) or math.isclose(share, 1 / 2), texts[k]
    assert [got[k].lang_pred for k in (40, 41, 42, 43)] == ["und"] * 4 and got[44].lang_pred != "und"


def test_language_never_learned_is_unfamiliar(spark):
    docs = spark.read.parquet(f"{MIDDLE_DIR}/documents.parquet")
    model = language_id.fit(docs.where(language_id.remainder("doc_id", 4) != 2))
    own = language_id.predict(docs.where(language_id.remainder("doc_id", 4) == 2), model, True).where("lang_pred <> 'und'")
    assert own.agg(F.min("familiarity")).first()[0] > 0.8
    other = ["Wszyscy ludzie rodzą się wolni i równi w swojej godności i prawach",
             "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
             "Wote wamezaliwa huru hadhi na haki zao ni sawa", "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar"]
    got = language_id.predict(frames.docs(spark, [*enumerate(other), (9, None), (10, "½")]), model, True).collect()
    assert all(r.familiarity < 0.4 for r in got) and sum(r.familiarity == 0 for r in got) >= 2


def test_language_held_out(spark):
    from storelens.llm.queries import op6_language_id

    docs = spark.read.parquet(f"{MIDDLE_DIR}/documents.parquet").select("doc_id", "lang")
    got = op6_language_id(spark, MIDDLE_DIR).join(docs, "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count() > 0


def brute_segments(scores):
    """Maximal scoring segments by definition: the best one, then what lies left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
               default=None)
    if best is None or best[0] <= 1e-12:
        return []
    a, b = best[3], best[4]
    return brute_segments(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in brute_segments(scores[b:])]


@pytest.mark.parametrize("seed", range(40))
def test_segments_equal_definition(seed):
    rng = random.Random(seed)
    scores = [rng.uniform(-3, 3) for _ in range(rng.randrange(0, 14))]
    got = toxicity.segments(np.array(scores))
    assert [(a, b) for a, b, _ in got] == brute_segments(scores)
    for a, b, s in got:
        assert math.isclose(s, sum(scores[a:b]))


def test_toxicity_finds_passages(spark):
    rng = random.Random(5)
    clean = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            words[20:20] = ["nasty", "awful"] * 3
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (5000, 1, None), (5001, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(frames.docs(spark, rows), table)
    calm = " ".join(clean[:80])
    odd = [(1, None), (2, ""), (3, "123"), (4, calm), (5, f"{calm} nasty awful nasty awful {calm}"), (6, "w1 " * 30000),
           (None, calm)]
    got = {r.doc_id: r for r in toxicity.score(frames.docs(spark, odd), model).collect()}
    assert got[5].toxicity >= 0.7 > max(got[k].toxicity for k in (1, 2, 3, 4, 6, None))
    passage = got[5].toxic_passages[0]
    assert odd[4][1][passage.begin:passage.end] == "nasty awful nasty awful"
    assert got[1].toxic_passages == [] and got[4].toxic_passages == []
    nothing = toxicity.fit(frames.docs(spark, rows), table.where("toxic = 0"))
    assert all(r.toxicity < 0.5 for r in toxicity.score(frames.docs(spark, odd), nothing).collect())
    assert toxicity.score(frames.docs(spark, []), model).count() == 0


def test_toxicity_scores_survive_sampling(spark):
    """Half of the texts with bad words are labelled toxic, 10 % of all: they score about 0.5 also where the cap binds."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(2000):
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        if i % 5 == 0:
            words[20:20] = ["nasty", "awful"] * 3
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 10 == 0)))
    docs, table = frames.docs(spark, rows).coalesce(2), spark.createDataFrame(labels, "doc_id long, toxic int").coalesce(2)
    bad = docs.where("doc_id % 5 = 0").coalesce(2)
    means = [toxicity.score(bad, toxicity.fit(docs, table, rows=n)).agg(F.avg("toxicity")).first()[0] for n in (10_000, 200, 100)]
    assert abs(means[0] - 0.5) < 0.05
    assert all(abs(m - means[0]) < 0.15 for m in means[1:]), means


def brute_toxicity(rows, labels, texts):
    """Log-odds, extreme values and curve of the stated rules, over plain counts."""
    toks = lambda t: toxicity.WORD.findall((t or "").lower())
    y_of = {}
    for i, y in labels:
        if i is not None and y in (0, 1):
            y_of[i] = max(y, y_of.get(i, 0))
    known = [(toks(t), y_of[i]) for i, t in rows if i in y_of]
    chain = lambda w: [w, *[w[:n] + "*" for n in (5, 4) if len(w) > n]]
    count = [Counter(x for ws, y in known if y == c for w in ws for x in chain(w)) for c in (0, 1)]
    total = [sum(len(ws) for ws, y in known if y == c) for c in (0, 1)]
    items = {*count[0], *count[1]}

    def above(item):
        stem = item.rstrip("*")
        return next((stem[:n] + "*" for n in (5, 4) if n < len(stem) and stem[:n] + "*" in items), None)

    def rates(item):
        """(score, chance in clean, chance in toxic) after the prior of the level above."""
        c, top = [count[0][item], count[1][item]], above(item)
        pooled = sum(c) / sum(total)
        base, prior = 0.0, [pooled, pooled]
        if top:
            base, *p = rates(top)
            prior = [x * sum(c) / (count[0][top] + count[1][top]) for x in p]
        # 20 tokens of prior evidence, half a token at least
        p = [max(n + 20 * q * t / (t + 20), 0.5) / (t + 20) for n, q, t in zip(c, prior, total, strict=True)]
        g2 = 2 * sum(n * math.log(n / (pooled * t)) for n, t in zip(c, total, strict=True) if n)
        odds = [math.log(x / (1 - x)) for x in p]
        return (odds[1] - odds[0] if g2 > 4.3 ** 2 else base, *p)

    memo = {}

    def token(w):
        if w not in memo:
            memo[w] = next((rates(x)[0] for x in chain(w) if x in items), 0.0) - 1
        return memo[w]

    best = lambda ws: sorted((sum(token(w) for w in ws[a:b]) for a, b in brute_segments([token(w) for w in ws])), reverse=True)[:5]
    clean = [(rates(w)[0] - 1, count[0][w] + 1e-9) for w in items if not w.endswith("*")]
    mass = sum(n for _, n in clean)
    low, high = 1e-6, 1.0
    mean = lambda x: sum(n * math.exp(min(700, x * s)) for s, n in clean) / mass
    while mean(high) < 1 and high < 50:
        high *= 2
    for _ in range(60):
        low, high = ((low + high) / 2, high) if mean((low + high) / 2) < 1 else (low, (low + high) / 2)
    seen = [(ws, best(ws), y) for ws, y in known]
    calm = [(len(ws), b) for ws, b, y in seen if not y and ws]
    scale = len(calm) / sum(n * math.exp(-high * (b[0] if b else 0)) for n, b in calm)

    def evidence(ws, tops):
        out = 0.0
        for r, s in enumerate(tops, 1):
            m = scale * len(ws) * math.exp(-min(700, high * s))
            tail = m ** r / math.factorial(r) if m < 0.1 else 1 - sum(m ** k * math.exp(-m) / math.factorial(k) for k in range(r))
            out = max(out, -math.log10(max(tail, 1e-300)))
        return min(out, 50.0)

    points = [(evidence(ws, b) if ws else 0.0, y) for ws, b, y in seen]
    a, slope = 0.0, 0.0
    for _ in range(4000):  # Newton steps on the ridged likelihood, by hand
        p = [1 / (1 + math.exp(-max(-30, min(30, a + slope * x)))) for x, _ in points]
        g = [sum(y - q for (_, y), q in zip(points, p, strict=True)) - 1e-3 * a,
             sum(x * (y - q) for (x, y), q in zip(points, p, strict=True)) - 1e-2 * slope]
        w = [q * (1 - q) for q in p]
        h = [sum(w) + 1e-3, sum(k * x for k, (x, _) in zip(w, points, strict=True)),
             sum(k * x * x for k, (x, _) in zip(w, points, strict=True)) + 1e-2]
        d = h[0] * h[2] - h[1] ** 2
        step = [(h[2] * g[0] - h[1] * g[1]) / d, (h[0] * g[1] - h[1] * g[0]) / d]
        a, slope = a + max(-2, min(2, step[0])), slope + max(-2, min(2, step[1]))
        if max(map(abs, step)) < 1e-9:
            break
    return [1 / (1 + math.exp(-(a + max(0.0, slope) * (evidence(toks(t), best(toks(t))) if toks(t) else 0.0)))) for t in texts]


def test_toxicity_equals_brute_force(spark):
    rng = random.Random(13)
    rows, labels = [], []
    for i in range(160):
        bad = i % 4 == 0
        words = [f"calm{rng.randrange(30)}" for _ in range(20)] + (["horridly", "horrible", "vile"] * 2 if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad) if i % 11 else int(not bad)))
    labels += [(None, 1), (7000, 1), (3, None), (5, 0), (5, 1)]
    texts = ["calm1 horrible calm2", "horridness vile", "calm3 " * 30, None, "", "unseen words", "horridly " * 6 + "calm1 " * 9, "vile"]
    model = toxicity.fit(frames.docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.toxicity for r in toxicity.score(frames.docs(spark, list(enumerate(texts))), model).collect()}
    want = brute_toxicity(rows, labels, texts)
    for k, w in enumerate(want):
        assert math.isclose(got[k], w, rel_tol=1e-5), (texts[k], got[k], w)
    assert want[6] > 0.7 > want[2]


def test_toxicity_held_out(spark):
    from storelens.llm.queries import op9_toxicity

    big = SMOKE_DIR.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = op9_toxicity(spark, big).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) > 0
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_rare_bigrams_count_in_both_models(spark):
    """A background 50 times the target's size: a bigram that stands once in it is still likelier than an unseen one."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(30)) for _ in range(100)]
    texts += ["zebra yak", "yak zebra"]
    targets = spark.createDataFrame([(0,), (1,)], "doc_id long")
    rows = list(enumerate(texts)) + [(200, "zebra yak")]
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(frames.docs(spark, rows), targets).collect()}
    assert got[100].background_loss == got[200].background_loss < -math.log(1 / 50) / 1.0
    assert got[100].background_loss < got[100].target_loss


def brute_losses(texts, targets, size):
    words = [lm_score.WORD.findall((t or "").lower()) for t in texts]
    top = sorted(Counter(w for ws in words for w in ws).items(), key=lambda x: (-x[1], x[0]))[:size - 2]
    numbers = {w: k for k, (w, _) in enumerate(top, 2)}
    ids = [[1, *[numbers.get(w, 0) for w in ws]] for ws in words]
    pairs = [Counter(), Counter()]
    for own, target in zip(ids, targets, strict=True):
        for model in ([0, 1] if target else [1]):
            pairs[model].update(zip(own, own[1:], strict=False))
    total = [sum(p.values()) for p in pairs]
    scale = [1.0, total[0] / total[1] if total[0] else 1.0]

    def loss(model, a, b):
        single = [sum(pairs[model][x, y] for x in range(size)) * scale[model] for y in range(size)]
        chance = (single[b] + 1) / (sum(single) + size)
        row = [pairs[model][a, y] for y in range(size)]
        if not sum(row):
            return -math.log(chance)
        freed = sum(c > 0 for c in row) * 3 / 4  # three quarters of each observed count's first occurrence
        return -math.log(max(row[b] - 3 / 4, 0) / sum(row) + freed / sum(row) * chance)

    return [[sum(loss(m, a, b) for a, b in zip(own, own[1:], strict=False)) / (len(own) - 1) if len(own) > 1 else None
             for m in (0, 1)] for own in ids]


def test_losses_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 30))) for _ in range(12)]
    texts += [None, "", "...", "A a  B"]
    rows = list(enumerate(texts))
    targets = spark.createDataFrame([(k, 1) for k in (0, 3, 4, 4, 99)] + [(None, 1)], "doc_id long, n long")
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(frames.docs(spark, rows), targets, size=9).collect()}
    want = brute_losses(texts, [k in (0, 3, 4) for k in range(len(texts))], 9)
    for i, (t, b) in enumerate(want):
        if t is None:
            assert got[i].n_tokens == 0 and got[i].target_loss is None and got[i].score is None
        else:
            assert math.isclose(got[i].target_loss, t, rel_tol=1e-5)
            assert math.isclose(got[i].background_loss, b, rel_tol=1e-5)
            assert math.isclose(got[i].score, got[i].target_loss - got[i].background_loss)
    none = lm_score.cross_entropy_difference(frames.docs(spark, rows), targets.where(F.lit(False)), size=9)
    assert none.where("n_tokens > 0 and target_loss is null").count() == 0
    assert lm_score.cross_entropy_difference(frames.docs(spark, []), targets, size=9).count() == 0


def test_losses_know_every_word(spark):
    """No word is unknown: the vocabulary follows the corpus, beyond the 2046 words that it once had at most."""
    rng = random.Random(9)
    texts = [" ".join(f"w{min(rng.randrange(4000), rng.randrange(4000))}" for _ in range(60)) for _ in range(150)] + ["", None]
    distinct = len({w for t in texts for w in (t or "").split()})
    assert distinct > 2046
    rows = list(enumerate(texts))
    targets = spark.createDataFrame([(k,) for k in range(0, 150, 3)], "doc_id long")
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(frames.docs(spark, rows), targets).collect()}
    want = sparse_losses(texts, [k % 3 == 0 and k < 150 for k in range(len(texts))], distinct + 2)
    for i, own in enumerate(want):
        assert (got[i].target_loss is None) == (own is None)
        if own:
            assert math.isclose(got[i].target_loss, own[0], rel_tol=1e-9)
            assert math.isclose(got[i].background_loss, own[1], rel_tol=1e-9)


def sparse_losses(texts, targets, size):
    """As brute_losses, with every word in the vocabulary."""
    own = [["<s>", *(t or "").split()] for t in texts]
    out = []
    pairs = [Counter(), Counter()]
    for words, target in zip(own, targets, strict=True):
        for model in ([0, 1] if target else [1]):
            pairs[model].update(zip(words, words[1:], strict=False))
    scale = [1.0, sum(pairs[0].values()) / sum(pairs[1].values())]
    rows, single = [{}, {}], [Counter(), Counter()]
    for m in (0, 1):
        for (a, b), n in pairs[m].items():
            rows[m].setdefault(a, []).append(n)
            single[m][b] += n * scale[m]

    def loss(m, a, b):
        chance = (single[m][b] + 1) / (sum(single[m].values()) + size)
        row = rows[m].get(a)
        if not row:
            return -math.log(chance)
        return -math.log(max(pairs[m][a, b] - 0.75, 0) / sum(row) + 0.75 * len(row) / sum(row) * chance)

    for words in own:
        k = len(words) - 1
        out.append([sum(loss(m, a, b) for a, b in zip(words, words[1:], strict=False)) / k for m in (0, 1)] if k else None)
    return out
