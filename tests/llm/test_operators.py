"""Operators against brute force, and their defined results for odd input."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (common, decontaminate, embeddings, licenses, mixing, queries, sharding, simhash, substrings,
                          tokens, toxicity, urls)
from tidemark.sinks import tables

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, extra=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}" if k % 5 else None, None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumns({c: F.lit(7) for c in extra or []})


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(n))


ODD = [None, "", "  \n\t ", "one", "two words", "é à", "x " * 30000, "same text here", "same text here", "a\x01b c"]


# ---------------------------------------------------------------- shared
def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(5, 5), (None, 3), (0, 299)]
    root = list(range(300))
    for a, b in [p for p in pairs if p[0] is not None] * 300:
        if root[a] != root[b]:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.component for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(found.get(i, i) == root[i] for i in range(300))
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- 1 mixing
def test_mixing_targets_and_odd_rows(spark):
    rows = [(i, "big" if i < 400 else ("mid" if i < 450 else None), 1 + i % 7) for i in range(460)]
    df = spark.createDataFrame(rows, "doc_id long, source string, t long").withColumn("block", F.lit(1))
    totals = Counter()
    for _, s, t in rows:
        totals[s] += t
    all_ = sum(totals.values())
    got = mixing.mix(df, tokens=F.col("t"), entropy=0.9, max_epochs=30.0, budget=all_, block_tokens=300).collect()
    spent = Counter()
    for r in got:
        spent[r.source] += r.n_tokens
    w = np.array([spent[s] for s in totals]) / sum(spent.values())
    assert abs(-(w * np.log(w)).sum() / np.log(3) - 0.9) < 0.03 and abs(sum(spent.values()) - all_) < 25
    epochs = defaultdict(Counter)
    for r in got:
        epochs[r.source, r.epoch][r.doc_id] += 1
    assert all(n == 1 for c in epochs.values() for n in c.values())  # each epoch is a permutation
    for b in {r.block for r in got}:
        assert sorted(r.place for r in got if r.block == b) == list(range(sum(r.block == b for r in got)))
    limited = mixing.mix(df, tokens=F.col("t"), entropy=1.0, max_epochs=2.0, budget=all_).groupBy("doc_id").count()
    assert limited.agg(F.max("count")).first()[0] <= 2
    whole = mixing.mixed_rows(df, tokens=F.col("t"), entropy=1.0, max_epochs=2.0)
    assert whole.select("doc_id").distinct().count() == 460 and whole.columns == df.columns
    with pytest.raises(ValueError):
        mixing.mix(df, tokens=F.col("t"), max_epochs=1.0, budget=10 * all_)


def test_mixing_empty_null_and_repeated(spark):
    assert mixing.mix(docs(spark, []), tokens=mixing.n_words(F.col("text")), entropy=0.9, budget=10).count() == 0
    df = docs(spark, ODD, ids=[None, None, 1, 1, 2, 3, 4, 5, 5, 6])
    got = mixing.mixed_rows(df, tokens=mixing.n_words(F.col("text")), entropy=0.5)
    assert got.count() >= len(ODD) and got.columns == df.columns


# ---------------------------------------------------------------- 2 tokens
def counted(enc, parts, rule):
    """Tokens of each section and those that reach beyond it, token by token and character by character."""
    owner = []  # the section of each character
    for k, part in enumerate(parts):
        lines = re.findall("[^\n]*\n|[^\n]+", part) or [""]
        if k < len(parts) - 1:
            lines[-1] += "\n"  # the joiner
        owner += [(k, n) for n, line in enumerate(lines) for _ in line]
    text, n, beyond, at = "\n".join(parts), Counter(), Counter(), 0
    place = [i for i, c in enumerate(text) for _ in c.encode()]  # the character of each byte
    for tok in enc.bpe.encode(text).tolist():
        chars = [owner[c] for c in sorted(set(place[at:at + int(enc.width[tok])]))]
        first = {"start": chars[0], "end": chars[-1]}.get(rule) or max(dict.fromkeys(chars), key=chars.count)
        n[first] += 1
        beyond[first] += len(set(chars)) > 1
        at += int(enc.width[tok])
    return n, beyond


@pytest.mark.parametrize("rule", tokens.RULES)
def test_token_attribution_by_characters(spark, rule):
    rng = random.Random(2)
    texts = [t for t in ODD if t is None or len(t) < 1000] + ["\n", "a\n", "\n\nb", "a\n\n\nb  \n \n c", "été\n\n\n\nx"]
    texts += [prose(rng, 100).replace(" g", "\n\n g").replace(" f", "\n\n\n").replace("a", "é") for _ in range(5)]
    ids = [None if i == 3 else i for i in range(len(texts))]
    df = docs(spark, texts, ids=ids, extra=["section", "field"]).withColumn("title", F.concat("source", F.lit("\n\n")))
    enc = tokens.Encoder(open(tokens.VOCABULARY, "rb").read())
    titles = {r.doc_id: r.title for r in df.collect()}
    for fields in (["text"], ["title", "text", "lang"]):
        got = tokens.section_tokens(df, fields=fields, rule=rule).collect()
        for i, t in zip(ids, texts):
            parts = [{"text": t, "title": titles[i], "lang": "en"}[f] or "" for f in fields]
            n, beyond = counted(enc, parts, rule)
            mine = [r for r in got if r.doc_id == i]
            assert sum(r.n_chars for r in mine) == len("\n".join(parts))
            assert {(fields.index(r.field), r.section): (r.n_tokens, r.n_crossing) for r in mine if r.n_tokens} == {
                k: (v, beyond[k]) for k, v in n.items()}
    assert tokens.section_tokens(docs(spark, [])).count() == 0


def test_token_counts_of_very_long_blanks(spark):
    df = docs(spark, [c * 2_000_000 + "x" for c in " \t"] + ["a" + "\n" * 1_200_000])
    got = tokens.section_tokens(df, separator="\r").collect()
    assert sorted(r.n_chars for r in got) == [1_200_001, 2_000_001, 2_000_001] and all(r.n_tokens > 1000 for r in got)


# ---------------------------------------------------------------- 3 decontamination
def test_decontamination_finds_copies_and_paraphrases(spark):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.randint(15, 60)) + ". " + prose(rng, 5) + ".") for k in range(30)] + [(30, None), (31, "")]
    clean = [prose(rng, rng.randint(20, 400)) for _ in range(60)]
    texts, want = list(clean) + ODD, set()
    for k in range(0, 30, 3):
        want.add((len(texts), k))
        texts.append(prose(rng, 150) + " " + items[k][1].upper() + " " + prose(rng, 150))
        words = items[k + 1][1].split()
        body = [w if j % 4 or j >= len(words) - 5 else "zzz" for j, w in enumerate(words)]
        want.add((len(texts), k + 1))
        texts.append(prose(rng, 100) + " " + " ".join(body) + " " + prose(rng, 50))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, texts, extra=["row", "cosine"])
    got = decontaminate.contaminated(df, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    parts = decontaminate.contaminated(df, bench, block_passages=7)
    assert {(r.doc_id, r.item_id) for r in parts.collect()} == want
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0


def test_decontamination_finds_paraphrases_of_one_sentence(spark):
    rng = random.Random(13)
    items = [(k, prose(rng, rng.randint(15, 59))) for k in range(20)] + [
        (k, prose(rng, 30) + ". " + prose(rng, 12) + ".") for k in range(20, 30)]
    texts = []
    for k, t in items:
        words = t.split()  # every fourth word replaced, the last one too; of items 20 to 24 the whole last sentence
        body = [w if (len(words) - j) % 4 != 1 else "zzz" for j, w in enumerate(words)] if not 20 <= k < 25 else [
            w if j < 30 else "zzz" for j, w in enumerate(words)]
        texts.append(prose(rng, 50) + " " + " ".join(body) + " " + prose(rng, 50))
    got = decontaminate.contaminated(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(k, k) for k in range(30) if not 20 <= k < 25}
    assert all(0.5 <= r.lcs < 0.8 for r in got)


def test_decontamination_with_more_passages_than_a_block(spark, monkeypatch):
    rng = random.Random(12)
    items = [(k, prose(rng, rng.randint(15, 59))) for k in range(290)] + [(k, prose(rng, 150)) for k in range(290, 300)]
    texts = [prose(rng, 100) + " " + t + " " + prose(rng, 100) for _, t in items[::7]]
    texts += [prose(rng, rng.randint(5, 300)) for _ in range(200)]
    sizes, block, scans, search = [], decontaminate._block, [], decontaminate._search
    monkeypatch.setattr(decontaminate, "_block", lambda c, q, *a: sizes.append(len(q)) or block(c, q, *a))
    monkeypatch.setattr(decontaminate, "_search", lambda *a: scans.append(1) or search(*a))
    got = decontaminate.contaminated(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, 7 * i) for i in range(len(items[::7]))}  # no clean one
    assert sum(sizes) == 290 + 10 * 3 and len(sizes) == 2 and max(sizes) <= 256 and len(scans) == 1


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            row[j + 1], last = (last + 1 if x == y else max(row[j], row[j + 1])), row[j + 1]
    return row[-1]


def test_decontamination_against_all_pairs(spark):
    """Recall and precision against a longest common subsequence of every passage with every region."""
    rng = random.Random(21)
    words = [prose(rng, 1) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(rng.randint(8, 130))) for k in range(40)]
    texts = []
    for k, t in items:
        ws = t.split()
        for every in (0, 3, 4, 6):  # copied, or every so many words replaced
            body = " ".join(w if not every or j % every else rng.choice(words) for j, w in enumerate(ws))
            texts.append(text(rng.randint(0, 90)) + " " + body + " " + text(rng.randint(0, 90)))
    texts += [text(rng.randint(1, 300)) for _ in range(60)]
    seen = Counter(w for t in texts for w in set(decontaminate.words_of(t)))
    weigh = lambda w: np.log((len(texts) + 1) / (seen[w] + 1)) + 1e-3
    want = set()
    for d, t in enumerate(texts):
        ws = decontaminate.words_of(t)
        for k, it in items:
            own = decontaminate.words_of(it)
            parts = -(-len(own) // 64)
            for p in range(parts):
                piece = own[p * len(own) // parts:(p + 1) * len(own) // parts]
                answer = decontaminate.telling_words((decontaminate.answer_of(it) if p == parts - 1 else piece)[-len(piece):], len(piece))
                for begin in range(0, len(ws), 32):
                    region = ws[max(0, begin - 32):begin + 96]
                    share = longest_common(piece, region) / len(piece)
                    rare = decontaminate.rare_words(piece, [weigh(w) for w in piece])
                    if share >= 0.8 or share >= 0.5 and longest_common(rare, region) >= 0.4 * len(rare) and \
                            longest_common(answer, region) >= -(-len(answer) // 3):
                        want.add((d, k))
    df, bench = docs(spark, texts).repartition(4), spark.createDataFrame(items, "item_id long, text string")
    exact = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench, cosine=-1.0).collect()}
    assert exact == want and {(4 * i + j, i) for i in range(40) for j in range(4)} <= {*want} | {(4 * i + 1, i) for i in range(40)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_decontamination_of_short_items_any_passage_and_scripts_without_spaces(spark):
    rng = random.Random(22)
    long_item = prose(rng, 150)
    first = long_item.split()[:50]
    items = [(1, "Paris is the capital"), (2, "yes"), (3, long_item), (4, "東京は日本の首都であり、世界最大の都市圏の一つである。"), (5, "two words"), (None, "three odd words")]
    texts = ["I know that PARIS is, the capital! of France", "paris is a capital", "yes", "yes it is", "Yes.", "two  words",
             prose(rng, 80) + " " + " ".join(w if j % 4 else "zzz" for j, w in enumerate(first)) + " " + prose(rng, 80),
             "昔々。東京は日本の首都であり、世界最大の都市圏の一つである。おわり", "京都は日本の古い都である。", None, "", "three odd words here"]
    ids = [*range(11), None]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(
        docs(spark, texts, ids=ids), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(0, 1), (2, 2), (4, 2), (5, 5), (6, 3), (7, 4), (None, None)}


@pytest.mark.parametrize("window", [8, 9, 2, 3])
def test_no_common_subsequence_is_longer_than_the_words_a_region_holds(window):
    rng = random.Random(window)
    half = window // 2
    span = -(-(window + 2 * half) // half)
    items = [[b"%d" % rng.randrange(12) for _ in range(rng.randint(5, 9))] for _ in range(6)]
    number = {w: i for i, w in enumerate(sorted({w for ws in items for w in ws}))}
    holds = np.array([[ws.count(w) for ws in items] for w in number], np.uint8)
    less = 0
    for n in (1, 7, 60, 200):
        text = [b"%d" % rng.randrange(30) for _ in range(n)]
        where = np.array([i for i, w in enumerate(text) if w in number], np.int64)
        at, folds = np.array([number[text[i]] for i in where], np.int64), -(-n // half)
        for first, last in ((0, folds), (folds // 2, folds), (0, 1)):
            most = decontaminate.most_common(holds, at, where // half, first, last, span)
            for k, j in itertools.product(range(first, last), range(len(items))):
                region = text[max(0, (k - 1) * half):k * half + window + half]
                common = decontaminate.common_words(decontaminate.places_of(items[j]), len(items[j]), region)
                around = set(text[max(0, (k - 1) * half):(k - 1 + span) * half])
                assert common <= most[k - first, j] == sum(w in around for w in items[j])
                less += most[k - first, j] < 0.5 * len(items[j])
    assert less > 100  # passages that need no subsequence


def test_common_subsequence_by_dynamic_programme():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([bytes([rng.choice(b"abcd")]) for _ in range(rng.randint(1, 40))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        bits = {}
        for i, w in enumerate(a):
            bits[w] = bits.get(w, 0) | 1 << i
        assert decontaminate.common_words(bits, len(a), b) == t[-1][-1]


# ---------------------------------------------------------------- 4 urls
def test_url_rules_trie_join_and_brute_force(spark):
    rng = random.Random(5)
    rules = [(".".join(rng.choice(["a", "b", "com", "net"]) for _ in range(rng.randint(1, 3))),
              rng.choice(["/", "/x/", "/x/y", "/x", "", "/x/y/"]), rng.choice(["allow", "block"])) for _ in range(40)]
    made = ["http://" + ".".join(rng.choice(["a", "B", "com", "net", "q"]) for _ in range(rng.randint(1, 4)))
            + rng.choice(["", "/", "/x", "/x/", "/x/y/z", "/x/yy", "/q?x=/x/", "#/x/", "?u"]) for _ in range(300)]
    made += [None, "", "no scheme/x", "://", "http://", "https://a.com://b/x", "HTTP://A.COM/X\n/y"]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(made)], "page_id long, url string, Verdict string")
    table = spark.createDataFrame([*rules, ("com", "/z", None)], "host string, path string, action string")
    best = {}
    for h, p, a in rules:
        best[h, p] = max(a, best.get((h, p), a))

    def judge(u):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(h.count(".") + 1 if h else 0, len(p), h + p, a) for (h, p), a in best.items()
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        win = max(fits, default=None)
        return host, path, win and win[2], win[3] if win else "allow"

    for limit in (1000, 0):
        got = urls.judge_urls(df, table, trie_limit=limit)
        assert [c.lower() for c in got.columns].count("verdict") == 1
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {
            i: judge(u) for i, u in enumerate(made)}
    assert urls.judge_urls(df.limit(0), table).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, table.limit(0)).collect()} == {"allow"}


# ---------------------------------------------------------------- 5 substrings
def brute_repeats(rows, length):
    low = {}
    last = float("inf")
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - length + 1):
            key = tuple(w[p:p + length])
            low[key] = min(low.get(key, last), last if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - length + 1):
            if low[tuple(w[p:p + length])] < (last if i is None else i):
                gone.update(range(p, p + length))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [20_000, 2])
def test_repeats_against_brute_force(spark, limit):
    rng = random.Random(6)
    shared = [prose(rng, 70) for _ in range(4)]
    texts = list(ODD) + ["r " * 130, "q " + "r " * 90, "é\x01 " * 60, "é " * 60]
    for _ in range(40):
        parts = [prose(rng, rng.randint(0, 60)), rng.choice(shared)[rng.randint(0, 60):], prose(rng, rng.randint(0, 60))]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    texts += texts[-3:] + texts[:2]
    ids = [rng.choice([None, k, k % 9]) if k % 11 == 0 else k for k in range(len(texts))]
    df = docs(spark, texts, ids, extra=["tkey", "low"])
    got = substrings.remove_repeats(df, length=20, group_limit=limit).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_repeats(list(zip(ids, texts)), 20)
    assert substrings.remove_repeats(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- 6 toxicity
def test_toxicity_separates_and_takes_odd_rows(spark):
    rng = random.Random(7)
    texts = [prose(rng, 60) for _ in range(400)]
    toxic = [k % 4 == 0 for k in range(400)]
    texts = [t.replace(" ", " vilegarbage ", 3) if x else t for t, x in zip(texts, toxic)]
    df = docs(spark, texts + ODD, extra=["score"])
    labels = spark.createDataFrame([(k, int(x)) for k, x in enumerate(toxic) if k < 300] + [(None, 1), (1, None), (5000, 1)],
                                   "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(df, toxicity.train(df, labels)).collect()}
    assert len(got) == 410 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[k] >= 0.5) == toxic[k] for k in range(300, 400)]) > 0.95
    none = toxicity.score(df, toxicity.train(df, labels.limit(0)))
    assert none.where("score >= 0.5").count() == 0
    assert toxicity.score(docs(spark, []), toxicity.train(docs(spark, []), labels)).count() == 0


# ---------------------------------------------------------------- 7 sharding
@pytest.mark.parametrize("n", [1, 3, 16])
def test_shards_against_prefix_sums(spark, n):
    rng = random.Random(8)
    rows = [(None if k % 50 == 0 else rng.randrange(80), rng.choice([0, 1, 5, 400])) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, b long").withColumns({"Shard": F.lit(1), "slot": F.lit(2)})
    df = df.withColumns({h: F.lit("x") for h in sharding.HELPERS})
    got = sharding.byte_shards(df, n, order_by=["doc_id", "b"], size=F.col("b"), partitions=5).collect()
    total, done, want = sum(b for _, b in rows), 0, Counter()
    for i, b in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        done += b
        want[i, b, min(n - 1, (2 * done - b) * n // (2 * total))] += 1
    assert Counter((r.doc_id, r.b, r.shard) for r in got) == want
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    empty = sharding.byte_shards(df.limit(0), n, order_by=["doc_id"], size=F.col("b"))
    assert empty.count() == 0


def test_shards_of_texts(spark):
    df = docs(spark, [*ODD, "y" * 3_000_000, "é" * 10], ids=[None, 3, 3, *range(4, 13)], extra=["size", "__first"])
    got = sharding.byte_shards(df, 4, order_by=["doc_id"], size=sharding.text_size(F.col("text"))).collect()
    assert Counter(r.text for r in got) == Counter([*ODD, "y" * 3_000_000, "é" * 10])
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)


# ---------------------------------------------------------------- 8 embeddings
def test_embedding_links_against_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((12, 16))
    x = np.concatenate([base[rng.integers(0, 12, 150)] + rng.standard_normal((150, 16)) * rng.uniform(0, 0.5, (150, 1)),
                        np.repeat(base[:1], 20, 0), base[:2] * 1e-30, base[2:4] * 1e30]).tolist()
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf"), 1.0], [1.0, 1.0], [2.0, 2.1], [-0.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(x + odd)] + [(3, x[3]), (None, x[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1))
    good = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    links = defaultdict(set)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
            p, q = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (a, b))
            if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.9:
                links[a].add(b)
                links[b].add(a)
    want = Counter()
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            todo = [c for b in todo for c in links[b] if c not in seen and not seen.add(c)]
        low = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        want[i, len(links[a]), low, i is not None and i == low] += 1
    for tile in (16, 2048):
        got = embeddings.near_duplicates(df, threshold=0.9, tile_rows=tile).collect()
        assert Counter(tuple(r) for r in got) == want
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bound_holds():
    x = embeddings._unit(np.random.default_rng(1).standard_normal((200, 32)))
    q, s, n, e = embeddings.quantise(x)
    near = (q * s[:, None]) @ (q * s[:, None]).T
    assert (np.abs(x @ x.T - near) <= n[:, None] * e[None] + e[:, None] + 1e-12).all()


# ---------------------------------------------------------------- 9 simhash
def test_position_sets_hold_in_any_five():
    sets = simhash.position_sets()
    assert len(sets) == 14 and all(any(set(s) <= set(five) for s in sets) for five in itertools.combinations(range(8), 5))


def brute_fingerprint(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("limit", [4096, 3])
def test_simhash_links_against_brute_force(spark, limit):
    rng = random.Random(10)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(30)} | {0, 7}
    fps = sorted(fps)
    root = list(range(len(fps)))
    near = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    for _ in range(len(fps)):
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.linked_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, limit)
    same = defaultdict(set)
    for r in got.collect():
        same[r.root].add(signed.index(r.fp))
    assert {frozenset(s) for s in same.values()} == {
        frozenset(i for i in range(len(fps)) if root[i] == k) for k in set(root) if root.count(k) > 1}


def test_simhash_documents(spark):
    rng = random.Random(11)
    long = prose(rng, 400)
    texts = ODD + [long, long.upper(), prose(rng, 300)]
    ids = [9, 8, None, *range(10, 10 + len(texts) - 3)]
    got = {(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(
        docs(spark, texts, ids, extra=["fp", "low"])).collect()}
    assert {(i, f) for i, f, _ in got} == {(i, brute_fingerprint(t)) for i, t in zip(ids, texts)}
    assert {c for i, f, c in got if f == 0} == {8} and len({c for i, f, c in got if i in (20, 21)} - {None}) <= 2
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- 10 licences
def dice_of(a, b):
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def words_of_licence(t):
    return re.sub("[^a-z0-9à-ÿ]+", " ", t.lower()).split()


def test_licences(spark):
    body = dict(licenses.TEMPLATES)["BSD-3-Clause"]
    inline = "Copyright 2020 Foo Inc. Released under the MIT License. All rights reserved."
    texts = ODD + ["Foo bar.\nLicensed under the Apache License, Version 2.0.\nmore text", "RELEASED   under the MIT license!",
                   "Licensed under the apache pear License, Version 3.1", "x\n\n" + "\n".join(body.split(". ")) + "\n\ny",
                   "licensed under cc by nc 4 0 " * 50, inline, "word " * 300 + inline + " word" * 4000]
    ids = [*range(len(texts) - 1), None]
    df = docs(spark, texts, ids=ids, extra=["license", "unit", "dice"])
    for limit in (10**6, 0):
        got = licenses.scan(df, licenses.templates_frame(spark), index_limit=limit).collect()
        found = {(r.doc_id, r.unit, r.place, r.license) for r in got}
        assert found >= {(10, "line", 1, "Apache-2.0"), (11, "line", 0, "MIT"), (15, "window", 4, "MIT"), (None, "window", 304, "MIT")}
        assert {x[3] for x in found if x[0] == 15} == {"MIT"} and "BSD-3-Clause" in {x[3] for x in found if x[0] == 13}
        assert 12 not in {r.doc_id for r in got} and all(0.8 <= r.dice <= 1 for r in got)
    assert licenses.scan(docs(spark, []), licenses.templates_frame(spark)).count() == 0
    assert licenses.scan(df, licenses.templates_frame(spark).limit(0)).count() == 0


def test_licence_windows_against_all_windows(spark):
    """Every window of a template's length, whether it begins with one of its bigrams or not."""
    rng = random.Random(31)
    filler = ["the", "software", "under", "license", "version", "is", "and", "any", *[prose(rng, 1) for _ in range(40)]]
    texts = []
    for name, body in licenses.TEMPLATES:
        ws = body.split()
        for drop in (0, 12, 7):
            own = [w for i, w in enumerate(ws) if not drop or i % drop != 3]
            texts.append(" ".join(rng.choices(filler, k=rng.randint(0, 60)) + own + rng.choices(filler, k=rng.randint(0, 60))))
    texts += [" ".join(rng.choices(filler, k=300)) for _ in range(20)]
    got = {}
    for r in licenses.scan(docs(spark, texts).repartition(3), licenses.templates_frame(spark)).collect():
        got[r.doc_id, r.license] = max(got.get((r.doc_id, r.license), 0), r.dice)
    grams = lambda ws: list(zip(ws, ws[1:]))
    templates = [(n, grams(words_of_licence(b))) for n, b in licenses.TEMPLATES]
    want = {}
    for d, t in enumerate(texts):
        own = grams(words_of_licence(t))
        for name, tg in templates:
            best = max((dice_of(own[p:p + len(tg)], tg) for p in range(max(1, len(own)))), default=0)
            whole = dice_of(own, tg) if own else 0
            if max(best, whole) >= 0.8:
                want[d, name] = max(want.get((d, name), 0), best, whole)
    assert got.keys() == want.keys(), (got.keys() ^ want.keys(), [want.get(k, got.get(k)) for k in got.keys() ^ want.keys()])
    assert all(abs(got[k] - want[k]) < 0.2 for k in want)  # a whole line is not cut to a better window


def test_urls_very_long_and_null(spark):
    rows = [(1, "http://a.com/" + "x/" * 200_000), (None, "http://example.com/en/"), (3, None), (4, "http://" + "a." * 100_000 + "net/es/")]
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got == {1: "allow", None: "block", 3: "allow", 4: "block"}


def test_text_scans_hand_python_small_batches(spark, monkeypatch, tmp_path):
    """Texts reach Python in Arrow batches of a bounded size, however large the session allows them; results are the same."""
    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "mb"]) for b in batches)

    long = spark.range(0, 4000, 1, 1).select(F.expr("repeat('abcdefgh', 256)").alias("text"))
    measured = long.mapInArrow(sizes, "n long, mb long")
    assert len(measured.collect()) == 1  # by default all rows of a partition
    with common.small_batches(spark):
        got = measured.collect()
    assert sum(r.n for r in got) == 4000 and max(r.mb for r in got) <= 1.1 * common.BATCH_BYTES

    before = spark.conf.get(common.BATCH_LIMIT)
    spark.conf.set(common.BATCH_LIMIT, "4096")
    try:
        with pytest.raises(ValueError), common.small_batches(spark):
            assert spark.conf.get(common.BATCH_LIMIT) == "4096"  # a smaller one stays
            raise ValueError
    finally:
        spark.conf.set(common.BATCH_LIMIT, before)

    limits = []

    def written(df, name):
        if re.search("MapInArrow|ArrowEvalPython", df._jdf.queryExecution().executedPlan().toString()):
            limits.append((name, int(spark.conf.get(common.BATCH_LIMIT))))
        return tables.materialize(df, name)

    for module in (decontaminate, simhash, corpus_pipeline):
        monkeypatch.setattr(module, "materialize", written)
    rng = random.Random(3)
    texts = [prose(rng, 40) for _ in range(40)]
    given = docs(spark, [*texts, texts[0]])
    items = spark.createDataFrame([(1, texts[5])], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(given, items).collect()] == [(5, 1)]
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(given).collect()}[40] == 0
    spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(40)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    corpus_pipeline.drop_toxic(spark, given, str(tmp_path))
    assert set(limits) == {(n, common.BATCH_BYTES) for n in ("decontaminate", "simhash", "pipeline")}
    assert spark.conf.get(common.BATCH_LIMIT) == before
