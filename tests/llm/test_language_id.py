import math
from collections import defaultdict

import numpy as np

from tests.llm.samples import documents, empty, frame_of
from umbu.llm import language_id as l

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, sums string, p string, logs string"
ROWS = "id bigint, text_hash bigint, text string, declared string, suffix string, host string"


def prose(lang, i):
    words = {
        "en": "the house and their garden were there with this winter weather that they thought".split(),
        "de": "das haus und der garten waren nicht über schöne straßen zwischen welche auch".split(),
        "fr": "la maison et le jardin étaient très près des écoles françaises où elle vécut".split(),
        "es": "la casa y el jardín estaban cerca de las montañas del año pasado también señor".split(),
    }[lang]
    return " ".join(words[(i * 7 + k * (1, 2, 4, 8, 11)[i % 5]) % len(words)] for k in range(30))


def rows():
    out = []
    for i in range(200):
        lang = ("en", "de", "fr", "es")[i % 4]
        declared = "en-US" if i % 10 == 9 else lang.upper()  # a tenth declare the wrong one
        out.append((i, 0, prose(lang, i), declared, {"de": "de"}.get(lang, "com"), f"{lang}.host{i % 3}"))
    return out


def test_languages_are_found_by_fused_evidence(spark):
    data = rows()
    odd = [
        (900, 0, None, "en", "com", "en.host0"), (901, 0, "", "en", None, None), (902, 0, "123 !!", "de", "de", "x"),
        (903, 0, "zq", None, None, None), (904, 0, "中文" * 50, "zh", "cn", "c"),
        (905, 0, "la", "es-MX", "com", "es.host1"), (906, 0, "la", "fr", "com", "fr.host1"), (None, 0, prose("de", 4), "", "", ""),
        data[0], (907, 0, prose("fr", 3) * 300, "xx-yy-zz and more", None, "fr.host0"),
    ]
    found = {r["id"]: r for r in l.identify(spark.createDataFrame(data + odd, ROWS)).collect()}
    for i in range(200):
        assert found[i]["lang"] == ("en", "de", "fr", "es")[i % 4] and found[i]["accepted"]
    for i in (900, 901, 902):
        assert found[i]["lang"] == "und" and not found[i]["accepted"]
    assert not found[904]["accepted"]
    # The text is of either language; the declaration and the host decide.
    assert found[905]["lang"] == "es" and found[906]["lang"] == "fr"
    assert found[None]["lang"] == "de" and found[907]["lang"] == "fr"
    assert l.identify(spark.createDataFrame(data + odd, ROWS)).count() == len(data + odd)


def test_unseen_trigrams_have_a_floor(spark):
    """However many trigrams a language has."""
    texts = spark.createDataFrame([("en", prose("en", i % 5) * 40) for i in range(200)], "declared string, text string")
    model = l.trigram_model(texts, ["en"])
    assert abs(model[:, 0].min() - (model[0, 1] - 0.6931)) < 1e-3


def test_stage_and_empty(spark):
    docs = frame_of(spark, documents(1))
    left = l.drop_rejected(docs)
    assert left.columns == docs.columns
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in left.collect()}
    assert gone == {500, 501, 502}
    assert l.drop_rejected(empty(spark)).count() == 0


def test_pages(spark):
    html = '<!DOCTYPE html><html lang="{}"><script>var the = "the and";</script><p>{}</p></html>'
    pages = [(i, f"http://{h}/x?y", html.format(d, t)) for i, _, t, d, _, h in rows()]
    pages += [(901, None, None), (902, "no address", "<p>")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    evidence = {r["id"]: r for r in l.page_evidence(df).collect()}
    assert (evidence[1]["declared"], evidence[1]["host"], evidence[1]["suffix"]) == ("DE", "de.host1", "host1")
    found = {r["id"]: r for r in l.identify(l.page_evidence(df)).collect()}
    assert found[1]["lang"] == "de" and found[2]["lang"] == "fr" and not found[901]["accepted"]


def brute(rows):
    """The query by plain loops over rows (doc_id, text, lang, source)."""
    def trigrams(text):
        kept = bytes(
            32 if b in (32, 9, 10, 11, 12, 13) else b
            for b in (text or "").encode().lower() if 97 <= b <= 122 or b >= 128 or b in (32, 9, 10, 11, 12, 13)
        )
        padded = b" " + kept + b" "
        triples = [padded[i : i + 3] for i in range(len(padded) - 2)]
        return [(int.from_bytes(t, "big") * 0x9E3779B1 % (1 << 32)) >> (32 - l.TRIGRAM_BITS) for t in triples if t != b"   "]

    chars = defaultdict(list)
    for _, text, lang, _ in rows:
        if lang and text:
            chars[lang].append(len(text))
    languages = sorted(x for x, n in chars.items() if sum(n) >= l.MIN_CHARS and len(n) >= l.MIN_ROWS)
    even, size = -l.TRIGRAM_BITS * math.log(2), 1 << l.TRIGRAM_BITS
    counts = {x: defaultdict(lambda: 0.05) for x in languages}
    for _, text, lang, _ in rows:
        for t in trigrams(text) if lang in counts else ():
            counts[lang][t] += 1
    total = {x: sum(c.values()) + 0.05 * (size - len(c)) for x, c in counts.items()}
    chance = lambda x, t: float(np.float32(max(math.log(counts[x].get(t, 0.05) / total[x]), even - math.log(2))))

    def softmax(logs):
        top = max(logs)
        return np.array([math.exp(x - top) for x in logs]) / sum(math.exp(x - top) for x in logs)

    n = len(languages) + 1
    flat = [(1 - l.UNKNOWN_SHARE) / len(languages)] * len(languages) + [l.UNKNOWN_SHARE]
    found = [trigrams(text) for _, text, *_ in rows]
    logs = [
        [sum(chance(x, t) for t in f) * l.TEMPER for x in languages] + [float(np.float32(even)) * len(f) * l.TEMPER] for f in found
    ]
    text_p = [softmax([a + math.log(p) for a, p in zip(g, flat)]) for g in logs]
    loud = [k for k, f in enumerate(found) if f]
    whole = sum((text_p[k] for k in loud), np.zeros(n)) + np.append(np.ones(n - 1), 0.1)
    whole /= whole.sum()
    smoothed = lambda s, above, w: (s + w * above) / (s.sum() + w)
    by = lambda key: {
        v: sum((text_p[k] for k in loud if rows[k][key] == v), np.zeros(n)) for v in {rows[k][key] for k in loud} - {None}
    }
    declared = {v: np.log(smoothed(s, whole, l.VALUE_WEIGHT) / whole) for v, s in by(2).items()}
    every = smoothed(sum((text_p[k] for k in loud), np.zeros(n)), whole, l.SUFFIX_WEIGHT)
    hosts = {v: smoothed(s, every, l.HOST_WEIGHT) for v, s in by(3).items()}
    out = []
    for k, (doc_id, _, lang, source) in enumerate(rows):
        p = softmax(np.array(logs[k]) + declared.get(lang, np.zeros(n)) + np.log(hosts.get(source, every)))
        name = [*languages, "und"][int(np.argmax(p))] if found[k] else "und"
        alone = [*languages, "und"][int(np.argmax(text_p[k]))] if found[k] else "und"
        out.append((str(doc_id), name, round(float(p.max()), 6), alone, name != "und" and bool(p.max() >= l.MIN_POSTERIOR)))
    return sorted(out)


def test_query_equals_brute_force(spark, tmp_path):
    """Five declared languages, a rare one, mixed and odd rows."""
    texts = [(i, t, d.lower()[:2], h) for i, _, t, d, _, h in rows()]
    texts += [(300 + i, " ".join("jag är inte här och det var en gång på ön".split()[(i + k) % 11] for k in range(40)), "sv", f"s{i % 2}") for i in range(40)]
    texts += [(400, "rare words", "xx", "a"), (401, None, "en", "a"), (402, "12 !", "de", None), (403, "the", None, None), (None, "la", "fr", "fr.host1")]
    texts += [texts[3], texts[3], (404, prose("en", 1) + " " + prose("de", 2), "sv", "s0")]
    docs = spark.createDataFrame([(*t, 0, "x", "y", None) for t in texts], DDL).repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = l.op1_language_id(spark, str(tmp_path)).collect()
    want = brute(texts)
    assert sorted((str(r["doc_id"]), r["lang"], round(r["posterior"], 6), r["text_lang"], r["accepted"]) for r in got) == want
    assert {x[1] for x in want} == {"de", "en", "es", "fr", "sv", "und"}
    # The fifth language stays in the corpus.
    kept = {r["doc_id"] for r in l.drop_rejected(docs).collect()}
    assert {*range(300, 340)} <= kept and not {401, 402} & kept


def test_languages_are_those_with_enough_text(spark):
    data = [("a" * 210, "en")] * 10 + [("c" * 199, "de")] * 10 + [("d" * 900, "und")] * 10 + [("e" * 9000, None)] * 10
    data = spark.createDataFrame(data + [("f" * 90_000, "it"), ("", "it")] * 9 + [(None, "fr")] * 20, "text string, declared string")
    assert l.declared_languages(data) == ["en"]
    assert l.declared_languages(data, 1, 1) == ["de", "en", "it"]
    assert l.declared_languages(data, 1, 1, 2) == ["en", "it"]
    none = l.identify(l.document_evidence(frame_of(spark, documents(1))), []).collect()
    assert {r["lang"] for r in none} == {"und"} and not any(r["accepted"] for r in none)
