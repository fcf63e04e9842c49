"""Each query against its SQL, a brute-force version, the public library, or held-out labels."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import regex
from caremill.llm import bpe, chat_format, decontamination, exact_dedup, html_extract, language_id, license_scan, lm_score, near_dedup, registry, substring_dedup
from caremill.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


def texts(spark, sf=SF):
    return {r[0]: r[1] or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())


def test_decontamination_in_parts_and_short_items(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    docs = {i: text(rng.choice([0, 1, 3, 30, 200])) for i in range(40)}
    items = [(i, text(rng.choice([0, 1, 2, 4, 13, 16]))) for i in range(12)]
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in docs.items():
        w, hit, found = t.split(), set(), set()
        for item, x in items:
            p = x.split()
            for a in range(len(p) - min(13, len(p)) + 1 if p else 0):
                win = p[a : a + 13]
                for at in range(len(w) - len(win) + 1):
                    if w[at : at + len(win)] == win:
                        hit |= set(range(at, at + len(win)))
                        found.add(str(item))
        want[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    for size in (decontamination.PART_BYTES, 60):
        got = {r.doc_id: (r.n_words, r.n_hit, sorted(r.item_ids), r.contaminated) for r in decontamination.contamination(frame, bench, part_bytes=size).collect()}
        assert got == want
        assert {r.doc_id for r in decontamination.drop_contaminated(frame, bench, part_bytes=size).collect()} == {i for i, x in want.items() if not x[3]}


def test_language_id_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    net = language_id.train(docs)
    rows = language_id.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)


def test_language_id_learns_every_language(spark):
    docs = spark.createDataFrame([(i * 80 + k, f"words of language {k}", f"l{k:02}") for i in range(12) for k in range(80)], "doc_id long, text string, lang string")
    assert language_id.train(docs, most=3, epochs=1).labels == [f"l{k:02}" for k in range(80)]


def test_language_id_gradients():
    net = language_id.Network(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    pieces, sizes, _ = language_id.cut([b"some bytes to learn from", b"xyz" * 30])
    wanted = np.array([0, 1, 2])[: len(pieces)]
    _, grads = net.gradients(pieces, sizes, wanted)
    rng = np.random.default_rng(0)
    for k, g in grads.items():
        flat = net.p[k].reshape(-1)
        used = np.flatnonzero(g.reshape(-1))
        for i in rng.choice(used, 3):
            was, ends = flat[i], []
            for step in (1e-3, -1e-3):
                flat[i] = was + step
                ends.append(net.gradients(pieces, sizes, wanted)[0])
            flat[i] = was
            assert math.isclose((ends[0] - ends[1]) / 2e-3, g.reshape(-1)[i], rel_tol=2e-2, abs_tol=1e-5), k


def test_language_id_against_a_byte_by_byte_run():
    net, rng = language_id.Network(["a", "b", "c"]), random.Random(3)
    n, span, lead = language_id.UNITS, language_id.SPAN, language_id.CONTEXT
    sig = lambda x: 1 / (1 + np.exp(-x))

    def states(data, d):
        h, out = np.zeros(n), []
        for byte in data:
            a, b = net.p["x" + d][byte].astype(float), h @ net.p["u" + d]
            z, r = sig(a[:n] + b[:n]), sig(a[n : 2 * n] + b[n : 2 * n])
            h = (1 - z) * np.tanh(a[2 * n :] + r * (b[2 * n :] + net.p["c" + d])) + z * h
            out.append(h)
        return out

    texts = [bytes(rng.choice(b"abc \xc3\xa9") for _ in range(k)) for k in (0, 1, 5, span - 1, span, span + 1, span + lead, 3 * span + 7)]
    got = language_id.probabilities(net, texts)
    for text, mine in zip(texts, got, strict=True):
        total = np.zeros(3)
        for at in range(0, len(text), span):
            first, stop = max(0, at - lead), min(len(text), at + span)
            f = states(text[first:stop], "f")[at - first :]
            b = states(text[at : min(len(text), at + span + lead)][::-1], "b")[::-1][: stop - at]
            for x, y in zip(f, b, strict=True):
                e = np.exp(x @ net.p["of"] + y @ net.p["ob"] + net.p["bias"])
                total += e / e.sum()
        assert np.allclose(mine, total / max(len(text), 1), atol=1e-5)


def test_license_scan_against_a_plain_search(spark):
    rows = {r.doc_id: r for r in license_scan.op3_license_scan(spark, SF).collect()}
    for i, t in texts(spark).items():
        w = words(t)
        places = [(at, label) for p, label in license_scan.BASE_PHRASES.items() for at in range(len(w)) if w[at : at + len(p.split())] == p.split()]
        text = f" {' '.join(w)} "
        fuzzy = {label for p, label, k in license_scan.NOTICES if regex.search(f"(?:{p}){{e<={k}}}", text)}
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.labels.split(",")) - {""} == fuzzy | {x for _, x in places}


def test_license_scan_finds_edits():
    got = license_scan.Scanner().scan(b"it is relesed undr the MIT licence here")
    assert got["labels"] == "mit" and got["base_labels"] == "" and 0.8 < got["score"] < 1 and got["notices"][0]["first_word"] == 2


def test_license_scan_finds_misspelt_base_phrases():
    scan = license_scan.Scanner().scan
    for text, label in (("distributed under the mit licence", "mit"), ("shared undr the mit licence", "mit"), ("shared under the mti license", "mit"), ("available under the apache licence version 2 0", "apache-2"), ("terms of cc by mc here", "cc-by-nc")):
        got = scan(text.encode())
        assert (got["labels"], got["n_base"], len(got["notices"])) == (label, 0, 1) and 0.8 < got["score"] < 1, text
    for text in ("available under the mpl license", "the apache license version 1 1", "shared as cc by nd 4 0", "under the old tree"):
        assert scan(text.encode())["labels"] == "", text
    assert [(x["first_word"], x["end_word"], x["edits"]) for x in scan(b"shared as cc by nc cc by nc")["notices"]] == [(2, 5, 0), (5, 8, 0)]
    assert len(scan(b"released under the mit license")["notices"]) == 1


def test_license_scan_finds_adjacent_notices():
    parts = [("released undr the mit licence", 2), ("released under the mit license", 0), ("released under the mit licence", 1), ("relesed undr the mit licence", 3)]
    for order in itertools.product(parts, repeat=3):
        text, want = " ".join(p for p, _ in order), []
        for p, edits in order:
            at = want[-1][1] if want else 0
            want.append((at, at + len(p.split()), edits))
        got = license_scan.Scanner().scan(text.encode())["notices"]
        assert [(x["first_word"], x["end_word"], x["edits"]) for x in got] == want and {x["label"] for x in got} == {"mit"}, text


def test_license_scan_leaves_other_licenses():
    scan = license_scan.Scanner().scan
    for text in ("released under the bsd license", "released under the x11 license", "released under the new license", "released under the it license", "licensed under cc by sa 4 0", "the apache license version 1 1", "licensed under the apache license version 1 0",
                 "mozilla public license version 1", "released into the public library"):
        assert scan(text.encode())["labels"] == "", text
    for text, label in (("creative commons attribution noncommercial", "cc-by-nc"), ("creative commons attribution noncomercial 4 0", "cc-by-nc"), ("creative commons attribution 4 0", "cc-by"), ("creative comons attribution share alike", "cc-by-sa"),
                        ("licensed under the gnu lesser general public license", "lgpl"), ("licensed under the gnu generl public license", "gpl"), ("mozila public license version 2 0", "mpl-2"),
                        ("permission is hereby granted free of charge to any person obtaining a copy of the font software", "ofl"), ("permission is herby granted free of charge to any person obtaining a copy of this software", "mit")):
        assert scan(text.encode())["labels"] == label, text
    got = scan(b"under the mit licence and released under the mit license")["notices"]
    assert [(x["first_word"], x["end_word"], x["edits"]) for x in got] == [(0, 4, 1), (5, 10, 0)]
    assert scan(b"it is cc by mc here")["score"] == 1 - 1 / 8 and scan(b"gnu lesser generl public licence")["score"] == 1 - 2 / 33


def test_license_scan_finds_names_in_every_form():
    scan = license_scan.Scanner().scan
    for text, label, edits in (("Distributed under the GNU General Public License v3", "gpl", 0), ("Licensed under GPL-3.0", "gpl", 0), ("Apache License 2.0", "apache-2", 0), ("Licensed under the Apache-2.0 license", "apache-2", 0),
                               ("SPDX-License-Identifier: MIT", "mit", 0), ("under the Mozilla Public Licence, v2", "mpl-2", 1), ("Licensed undr the Apach Licens Version2.0", "apache-2", 4), ("relased under the mitlicense", "mit", 2),
                               ("The MIT Licence", "mit", 1), ("under the LGPL v2.1", "lgpl", 0), ("SPDX-License-Identifier: AGPL-3.0-or-later", "agpl", 0)):
        got = scan(text.encode())
        assert (got["labels"], [x["edits"] for x in got["notices"]]) == (label, [edits]), text
    for text in ("studied under the MIT professor", "released under the emitlicense", "under the kit license", "apache 1.1 license", "apache license v1", "mpl 1.1 license", "under the bgp", "apache licens version1 0",
                 "under the apache server", "under the ggpl", "the unit license"):
        assert scan(text.encode())["labels"] == "", text
    rng = random.Random(4)
    for phrase, label, edits in rng.sample(license_scan.named_notices(), 30):  # every form is found among other words, at its place
        got = scan(f"some words {phrase.strip()} and more".encode())
        assert got["labels"] == label and got["score"] == 1 and min(x["first_word"] for x in got["notices"]) >= 2, phrase


def test_slip():
    for a, b, same in (("mit", "mti", True), ("mit", "mot", True), ("mit", "mit", True), ("nc", "mc", True), ("mit", "kit", False), ("mit", "it", False), ("mit", "mni", False), ("nc", "nd", False)):
        assert license_scan.slip(a, b) == same, (a, b)


def test_one_edit():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(2))
        near = {a} | {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i + k :] for i in range(len(a) + 1) for c in "ab" for k in (0, 1)} | {a[:i] + a[i : i + 2][::-1] + a[i + 2 :] for i in range(len(a))}
        assert license_scan.one_edit(a, b) == (b in near), (a, b)


def test_bpe_against_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.tokenizer_path()
    library = Tokenizer.from_file(path)
    odd = ["", "a" * 300 + " ΑΣΣ Σ ΣΑΣ.", "<|endoftext|>Hello<|startoftext|> <|ENDOFTEXT|>", "İstanbul \x1c\x1d x\x85y　z it's we'LL 12 ½ ₂ ٣ éé é ﬁ 😀😁 ﻿​", "th" * 500 + "in" * 333, "\x00\x01", "ǅ ǈ ẞ ß"]
    docs = texts(spark) | {-i: t for i, t in enumerate(odd, 1)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    folder = bpe.build_lexicon(frame, path, 500)
    ids = {r.doc_id: r.ids for r in bpe.encode(frame, path, folder).collect()}
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(frame, path, folder), path, folder).collect()}
    made = {r.doc_id: r for r in bpe.coded(frame, path, folder).collect()}
    for i, t in docs.items():
        want = library.encode(t, add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        assert ids[i] == want and back[i] == text
        assert (made[i].n_tokens, made[i].ids_sha256, made[i].decoded_sha256) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_lexicon_shares_suffixes():
    lexicon = bpe.Lexicon.compiled(sorted([b"tested", b"rested", b"nested", b"test"]), [[1], [2], [3], [4]])
    assert len(lexicon.keys) == 3 * 2 + 4 + 2  # r and n share all that follows; t keeps "test" final
    assert lexicon.places([b"nested", b"rested", b"test", b"tested", b"tes", b"x", b""]).tolist() == [0, 1, 2, 3, -1, -1, -1]


def test_lm_score_against_plain_counts(spark):
    docs = texts(spark)
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) + [None]
    pairs, one = Counter(), Counter()
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 10:
            pairs.update(zip(["<s>", *cut(t)], cut(t)))
            one.update(cut(t))
    context, times, follows = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (a, b), n in pairs.items():
        context[a] += n
        times[a][min(n, 3) - 1] += 1
        follows[b] += 1
    of = lambda counts: lm_score.discounts([Counter(counts)[i] for i in (1, 2, 3, 4)])
    d, low = of(pairs.values()), of(follows.values())
    types = Counter(min(x, 3) for x in follows.values())
    spare = sum(low[i - 1] * types[i] for i in (1, 2, 3)) / len(pairs)
    lowest = lambda b: max(follows[b] - [0, *low][min(follows[b], 3)], 0) / len(pairs) + spare / (len(one) + 1)

    def p(a, b):
        if not context[a]:
            return lowest(b)
        n = pairs[a, b]
        return max(n - [0, *d][min(n, 3)], 0) / context[a] + sum(x * y for x, y in zip(d, times[a], strict=True)) / context[a] * lowest(b)

    for a in ("the", "<s>", "never seen"):
        assert math.isclose(sum(p(a, b) for b in list(one)) + p(a, "unseen"), 1)
    frame = table(spark, SF, "documents")
    for size in (lm_score.SHARD_TOKENS, 20_000):
        for r in lm_score.score(frame, lm_score.learn(frame, size)).collect():
            t = cut(docs[r.doc_id])
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(b in one for b in t), one.total())
            assert math.isclose(r.base_score, sum(math.log10((one[b] + 0.1) / (one.total() + 0.1 * (len(one) + 1))) for b in t), rel_tol=1e-9)
            assert math.isclose(r.score, sum(math.log10(p(a, b)) for a, b in zip(["<s>", *t], t)), rel_tol=1e-6)


def test_best_region_is_the_best():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-2, -1, 0, 1, 2]) for _ in range(rng.randrange(9))]
        a, b = html_extract.best_region(scores)
        assert sum(scores[a:b]) == max(sum(scores[i:j]) for i, j in itertools.combinations_with_replacement(range(len(scores) + 1), 2))


def test_html_extraction_with_and_without_the_mark(spark):
    pages = table(spark, SF, "pages")
    weights = html_extract.learned_weights(pages)
    assert all(v < 0 for k, v in weights.items() if k.startswith("tag")) and weights["word plain"] > 0
    for _, _, page in pages.select("page_id", "url", "html").collect():
        got = html_extract.main_text(page, weights)
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        import html

        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body))
        assert got == "\n".join(b for b in blocks if b)
        assert html_extract.main_text(page.replace("<article>", "<div>").replace("</article>", "</div>"), weights) == got


def test_html_extraction_leaves_boilerplate(spark):
    weights = html_extract.learned_weights(table(spark, SF, "pages"))
    page = "<body><header><h1>Site</h1></header><div id=cookie-notice>We use cookies on this <a>site</a></div><main><h1>Title &amp; x</h1><p>Some text long enough<br>to be read &lt;b&gt; by all</p><form>name<input></form><ul><li>one<li>two</ul><div class='comments'>great post</div></main><aside>side text</aside><footer>foot"
    assert html_extract.main_text(page, weights) == "Title & x\nSome text long enough to be read <b> by all\none\ntwo"


def test_html_extraction_of_text_outside_article_elements(spark):
    weights = html_extract.learned_weights(table(spark, SF, "pages"))
    prose = "<h1>Title of the page</h1><p>The main text of this page stands here and is long enough to be read by all.</p><p>A second paragraph of the main text follows the first one.</p>"
    want = "Title of the page\nThe main text of this page stands here and is long enough to be read by all.\nA second paragraph of the main text follows the first one."
    menu, foot = "<body><nav><a href=/>home</a></nav>", "<footer>foot</footer>"
    teasers = "<aside><article><h2><a href=/1>One teaser</a></h2><p>Short</p></article><article><h2><a href=/2>Two</a></h2></article></aside>"
    comments = "<section class='comments'><article><p>A reader wrote a comment that is rather long.</p></article><article>Great post</article></section>"
    for cards in (teasers, comments):
        assert html_extract.main_text(f"{menu}<main>{prose}{cards}</main>{foot}", weights) == want
        assert html_extract.main_text(f"{menu}<main>{cards}{prose}</main>{foot}", weights) == want
    plain = "<article><p>A card in the main text, with words of its own.</p></article>"
    assert html_extract.main_text(f"{menu}<main>{prose}{plain}</main>{foot}", weights) == f"{want}\nA card in the main text, with words of its own."
    before = prose.replace("</h1>", "</h1><article>")
    assert html_extract.main_text(f"{menu}<main>{before}</article></main>{foot}", weights) == want


def _without_the_mark(page):
    return page.replace("<article>", "<div>").replace("</article>", "</div>")


def test_html_extraction_comes_from_the_scan_and_learned_names(spark, monkeypatch):
    pages = table(spark, SF, "pages").select("page_id", "url", "html")
    weights = html_extract.learned_weights(pages)
    raw = [_without_the_mark(r.html) for r in pages.collect()]
    want = [html_extract.main_text(p, weights) for p in raw]
    renamed = html_extract.learned_weights(pages.selectExpr("page_id", "url", "replace(html, 'class=\"ad\"', 'class=\"zork\"') AS html"))
    assert renamed["class:zork"] < -2 and [html_extract.main_text(p.replace('class="ad"', 'class="zork"'), renamed) for p in raw] == want
    monkeypatch.setattr(html_extract, "best_region", lambda scores: (0, len(scores)))
    assert all(html_extract.main_text(p, weights) != w for p, w in zip(raw, want, strict=True))


def test_html_extraction_keeps_all_of_the_article(spark):
    weights = html_extract.learned_weights(table(spark, SF, "pages"))
    inner = '<section id="related-work"><p>one a</p></section><h2 id="legal">two b</h2><div class="side-effects"><p>three</p></div><section class="comments-on-theory"><p>four</p></section><p>x <math><mi>five</mi></math></p><ul><li>six</li></ul>'
    prose = "<p>The main text of this page stands here and is long enough to be read by all.</p>"
    lines = ["one a", "two b", "three", "four", "x five", "six"]
    for body in (f"{inner}{prose}", f"{prose}{inner}", f"{prose}{inner}{prose}"):
        for page in (f"<nav><a href=/>home</a></nav><article>{body}</article><footer>foot</footer>", f"<nav><a href=/>home</a></nav><div>{body}</div><footer>foot</footer>"):
            got = html_extract.main_text(page, weights).split("\n")
            assert [x for x in got if x in lines] == lines and "foot" not in got and "home" not in got


def test_html_extraction_of_hostile_markup():
    import time

    extractor = html_extract.Extractor(html_extract.weights_of(Counter(), Counter()))
    began = time.time()
    for page in ("<p>word</p><img " + " ".join(f'a{i}="v{i}"' for i in range(40)), "<a " * 333_333, "<p '" * 200_000, "<p>a" + '="' * 300_000, "</x>" * 100_000 + "<x>" * 100_000, "".join(f"<x{i}>" for i in range(100_000)), "<div class=a>" * 100_000, '"x"' * 18 + "<", "<!" * 300_000, "<!--" * 200_000, "<script>" * 50_000):
        extractor.text(page)
    assert time.time() - began < 15
    assert extractor.text("<p>word</p><img " + " ".join(f'a{i}="v{i}"' for i in range(40))) == "word"
    assert extractor.text("<p>1 < 2 &lt;b&gt; and <3</p>") == "1 < 2 <b> and <3"


def test_near_dedup_against_all_pairs(spark):
    rows = near_dedup.op9_near_dedup(spark, SF).collect()
    docs = table(spark, SF, "documents")
    idf, shingles = near_dedup.document_frequencies(docs), near_dedup.Shingles()
    found = {}
    for i, t in texts(spark).items():
        s, n = shingles.of(t.encode())
        found[i] = (s, n * idf[near_dedup.feature(s)])
    top = {i: i for i in found}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in itertools.combinations(found, 2):
        if near_dedup.weighted_jaccard(found[a], found[b]) >= 0.8:
            x, y = sorted((root(a), root(b)))
            top[y] = x
    assert {r.doc_id: r.class_id for r in rows} == {i: root(i) for i in found}
    sizes = Counter(root(i) for i in found)
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)


def test_near_dedup_of_a_large_bucket(spark):
    """Three hundred near copies of one text, in a chain of edits: one class, and texts between two classes link them."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(300):
        w = list(base)
        for at in rng.sample(range(300), 3):
            w[at] = f"e{i}x{at}"
        texts.append((i, " ".join(w)))
    texts.append((1000, " ".join(f"other{i}" for i in range(300))))
    got = near_dedup.near_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: 0 if i < 1000 else 1000 for i, _ in texts}


def test_sampling_estimates_weighted_jaccard():
    rng, sampler = np.random.default_rng(3), near_dedup.Sampler()
    s = np.sort(rng.integers(0, 2**63, 300, dtype=np.uint64))
    same = []
    for _ in range(40):
        a, b = rng.random(300) + 0.1, rng.random(300) + 0.1
        same.append(((sampler.sample(s, a) == sampler.sample(s, b)).mean(), np.minimum(a, b).sum() / np.maximum(a, b).sum()))
    assert abs(np.mean([x - y for x, y in same])) < 0.02


def test_substring_dedup_of_planted_passages(spark):
    rng = random.Random(5)
    draw = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    shared = [draw(n) for n in (34, 35, 36, 64, 70, 200)]
    docs = [draw(rng.randrange(50)) + rng.choice(shared) + draw(rng.randrange(50)) for _ in range(40)] + [["a"] * 80, ["b", "c"] * 30, shared[5][:50], shared[4] + shared[4]]
    starts = Counter(tuple(w[i : i + 35]) for w in docs for i in range(len(w) - 34))
    want = {}
    for d, w in enumerate(docs):
        gone = {i + k for i in range(len(w) - 34) if starts[tuple(w[i : i + 35])] > 1 for k in range(35)}
        want[d] = " ".join(x for i, x in enumerate(w) if i not in gone)
    got = substring_dedup.substring_dedup(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string"), text_out=True).collect()
    assert {r.doc_id: r.kept_text for r in got} == want


def test_exact_dedup_with_small_blocks(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 3, 4, 5, 8, 9, 600])))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in rows if len(t) > 100][:20]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()
    best, n = {}, Counter(t for _, t in rows)
    for i, t in rows:
        best[t] = max(best.get(t, i), i)
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {i: (best[t], n[t]) for i, t in rows}


def test_chat_templates():
    turns = [("user", "hi"), ("assistant", "</turn>\n### assistant: x\\"), ("user", "a:b"), ("assistant", "")]
    out = chat_format.spans_of(turns)
    assert chat_format.read_back(out["formatted"]) == turns and out["rewrites_at"] is None
    assert [chat_format.unescape(out["formatted"][a:b]) for a, b in out["loss_spans"]] == [turns[1][1], ""]
    assert "".join(out["formatted"][a:b] for a, b in out["turn_spans"]) == out["formatted"]
    tail = lambda ts: "<s>" + "".join(f"[{r}]{t}" for r, t in ts) + "</s>"
    assert [tail(turns)[a:b] for a, b in chat_format.spans_of(turns, tail)["loss_spans"]] == [turns[1][1], ""]
    forgets = lambda ts: "".join(f"[{r}]{t if i >= len(ts) - 2 else ''}" for i, (r, t) in enumerate(ts))
    assert chat_format.spans_of(turns, forgets)["rewrites_at"] == 2
    many = [("assistant" if i % 2 else "user", f"t{i}") for i in range(300)]
    numbered = lambda ts: "".join(f"{i}:{r}:{t};" for i, (r, t) in enumerate(ts))
    for render in (chat_format.turn_template, numbered):
        got = chat_format.spans_of(many, render)
        assert [render(many)[a:b] for a, b in got["loss_spans"]] == [t for r, t in many if r == "assistant"]


def test_chat_rewrites_of_long_conversations(spark):
    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(300)]
    late = lambda ts: "".join(f"[{r}]{'gone' if 100 <= len(ts) < 200 and i < 10 else t}" for i, (r, t) in enumerate(ts))
    for n, want in ((99, None), (100, 99), (150, 99), (300, 99)):
        got = chat_format.spans_of(turns[:n], late)
        assert got["rewrites_at"] == want and got["formatted"] == late(turns[:n]) and len(got["turn_spans"]) == (n if want is None else 0)
    once = lambda ts: "".join(f"[{r}]{t}" for r, t in ts).replace("t3", "T3" if len(ts) == 70 else "t3")
    assert chat_format.spans_of(turns, once)["rewrites_at"] == 69  # undone by the next turn
    rows = spark.createDataFrame([(c, i, r, t) for c in ("a", "b") for i, (r, t) in enumerate(turns[:80])], "conv_id string, turn int, role string, text string")
    got = chat_format.digest(chat_format.format_conversations(rows)).collect()
    loss = "".join(t for r, t in turns[:80] if r == "assistant")
    assert sorted((r.conv_id, r.n_turns, r.loss_chars, r.loss_sha256) for r in got) == [(c, 80, len(loss), hashlib.sha256(loss.encode()).hexdigest()) for c in ("a", "b")]


def test_pipeline_against_plain_python(spark):
    """Languages as the trained network says; copies, near copies, contamination and ids by brute force."""
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = table(spark, SF, "documents")
    label = {r.doc_id: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    kept = {i: t for i, t in texts(spark).items() if label[i].lang_pred != "und" and label[i].score >= language_id.REJECT}
    last = {t: i for i, t in sorted(kept.items())}
    kept = {i: t for t, i in last.items()}
    frame = spark.createDataFrame(list(kept.items()), "doc_id long, text string")
    idf, shingles = near_dedup.document_frequencies(frame), near_dedup.Shingles()
    found = {i: (lambda s, n: (s, n * idf[near_dedup.feature(s)]))(*shingles.of(t.encode())) for i, t in kept.items()}
    top = {i: i for i in kept}
    for _ in range(3):
        for a, b in itertools.combinations(sorted(kept), 2):
            if near_dedup.weighted_jaccard(found[a], found[b]) >= 0.8:
                top[a] = top[b] = min(top[a], top[b])
    kept = {i: t for i, t in kept.items() if top[i] == i}
    items = [words(r.text) for r in table(spark, SF, "benchmark").collect()]
    grams = {tuple(w[i : i + 13]) for w in items for i in range(max(1, len(w) - 12)) if w}
    clean = {}
    for i, t in kept.items():
        w = words(t)
        hit = {k for size in {len(g) for g in grams} for at in range(len(w) - size + 1) if tuple(w[at : at + size]) in grams for k in range(at, at + size)}
        if not hit or 20 * len(hit) < len(w):
            clean[i] = t
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_path())
    want = {i: hashlib.sha256(" ".join(map(str, library.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for i, t in clean.items()}
    assert {i: r.ids_sha256 for i, r in rows.items()} == want
