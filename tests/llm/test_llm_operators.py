"""The training-data operators against brute force on small fixtures: nulls, empty texts, ties, repeated rows, empty
tables and clashing column names included.  Queries with SQL are held against DuckDB on whole tables."""

import collections
import hashlib
import json
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as se  # noqa: E402
from chatsift.llm import (chat_format, components, exact_dedup, html_text, jaccard_join, line_dedup, mixing, packing,  # noqa: E402
                          perplexity, quality_fm, suffix_dedup)
from chatsift.llm.queries import ORACLE, QUERIES, tokenizer_file  # noqa: E402

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def spark():
    from chatsift.session import local_session

    s = local_session("*", 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    line = "this line 17 recurs in very many documents indeed ."
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id at all", "en", "b", 3), (3, "x " * 30_000, "de", None, 1),
            (4, "same text here\n" + line, "en", "a", 5), (4, "same text here\n" + line, "en", "a", 5),
            (5, "Same  text here\n" + line.replace("17", "99"), "en", "c", 5), (6, "\n\n \t\n", None, "c", 2),
            (7, line + "\n" + line, "fr", "b", 9), (8, "same text here\n" + line, "en", "z", 5)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(SMALL + "/documents.parquet").to_pylist()


def _rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    rounded = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(map(rounded, res.fetchall()), key=repr) == sorted((rounded(r) for r in df.select(*names).collect()), key=repr)


def test_every_operator_is_registered():
    assert {int(m[1]) for k in se.queries() if (m := re.match(r"op(\d+)_", k))} == set(range(1, 14))
    assert "pipeline" in se.queries()


def test_odd_rows_do_not_break_any_operator(spark, odd):
    empty = odd.where("false")
    extra = odd.withColumn("places", F.lit(1)).withColumn("size", F.lit("s")).withColumn("target", F.lit(2.0))
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (3, None)], "doc_id long, quality int")
    n = odd.count()
    for docs, count in ((odd, n), (empty, 0), (extra, n)):
        assert len(_rows(line_dedup.dedup_lines(docs, counts=True))) == count
        assert len(_rows(mixing.mix(docs))) == count
        assert len(_rows(perplexity.perplexity_rules(docs))) == count
        assert len(_rows(jaccard_join.jaccard_components(docs))) == count
        assert len(_rows(suffix_dedup.remove_repeats(docs))) == count
        assert len(_rows(exact_dedup.exact_dedup(docs))) == count
        assert len({r["doc_id"] for r in _rows(packing.pack_texts(docs, tokenizer_file))}) == (9 if count else 0)
        model = quality_fm.train(docs, labels)
        assert all(0 <= r["score"] <= 1 for r in _rows(quality_fm.score(docs, model)))
        assert quality_fm.keep_good(docs, model).columns == docs.columns
        assert line_dedup.dedup_lines(docs).columns == docs.columns
        assert mixing.mixed_documents(docs).columns == docs.columns
        assert jaccard_join.one_of_each(docs).columns == docs.columns


def test_line_dedup_generalises_and_keeps_the_first(spark):
    base = "user {} opened the door of room {} at noon"
    docs = spark.createDataFrame([(i, f"own line of document {'abcdefgh'[i]} with its words\n" + base.format("anna bob cleo dora".split()[i], i))
                                  for i in range(4)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].count("\n") for r in _rows(line_dedup.dedup_lines(docs))}
    assert got[0] == 1 and all(got[i] == 0 for i in (1, 2, 3))


@pytest.mark.parametrize("docs, cities, months", [(5, 5, 5), (100, 20, 12), (600, 25, 20)])
def test_line_templates_generalise_however_often_their_values_recur(spark, docs, cities, months):
    line = "Please contact our {} office for further details before the end of {}"
    words = lambda stem, n: [stem + a + b for a in "abcde" for b in "vwxyz"][:n]
    pairs = [(c, m) for c in words("city", cities) for m in words("month", months)] if docs > 5 else list(zip(words("c", 5), words("m", 5)))
    order = random.Random(3).sample(range(docs), docs)
    # A second template and prose share the leading words and the number of words.
    other = "Please contact our {} helpdesk if this message does not show up properly"
    rows = [(i, line.format(*pairs[order[i] % len(pairs)]) + "\n" + other.format(words("team", 25)[i % 25])) for i in range(docs)]
    prose = "Please contact our friend who once drew nine maps of another quiet town"
    rows += [(docs, prose)]
    got = {r["doc_id"]: r for r in _rows(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True))}
    assert got[0]["n_dropped"] == 0 and got[docs]["text"] == prose
    assert [got[i]["n_dropped"] for i in range(1, docs)] == [2] * (docs - 1)


def test_large_leaves_get_the_same_templates(spark, monkeypatch):
    draw = random.Random(5)
    lines = {"a b c " + " ".join(draw.choice("pqrstuv"[:2 + k]) for k in range(5)) for _ in range(60)} | {f"a b d {w} x" for w in "mn"}
    near = spark.createDataFrame([(len(x), x) for x in sorted(lines)], "leaf long, masked string")
    whole = sorted(_rows(line_dedup.general_templates(near)), key=repr)
    monkeypatch.setattr(line_dedup, "HOT_LEAF", 5)
    assert whole and whole == sorted(_rows(line_dedup.general_templates(near)), key=repr)


def test_line_dedup_of_short_and_long_lines(spark):
    numbers = "one two three four five six seven eight nine ten".split()
    passage = " ".join(f"{a}{b}" for a in numbers for b in "pqrstu")  # 60 words
    own = lambda i: f"w{'abcdefghij'[i % 10]}{'klmno'[i // 10]}x"
    rows = [(i, "\n".join([own(i), "All rights reserved.", "Read 3 more", "Read 4 more"][:3 + (i < 9)] + ["}"] * 3)) for i in range(50)]
    rows += [(90, "alpha\n" + passage), (91, passage + "\nbeta"), (92, passage.replace("onep", "other") + "\ngamma"),
             (93, "five words that recur here"), (94, "five words that recur here")]
    got = {r["doc_id"]: r["text"] for r in _rows(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got[0] == rows[0][1]
    for i in range(1, 50):  # found in 50 and in 9 documents; single words and marks stay
        assert got[i] == "\n".join([own(i)] + ["Read 4 more"] * (i < 9) + ["}"] * 3)
    assert (got[90], got[91], got[92]) == (rows[50][1], "beta", rows[52][1])
    assert got[93] == got[94] == "five words that recur here"


def test_short_lines_are_judged_by_their_part_of_all_rows(spark):
    rows = [(i, f"Read it all\nq{i}") for i in range(12)] + [(i, None) for i in range(12, 2600)]
    got = {r["doc_id"]: r["text"] for r in _rows(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert all(got[i] == t for i, t in rows)  # 12 documents are fewer than 13, one in 200


def test_chat_round_trip(spark):
    codec = chat_format.Codec(chat_format.Template())
    rng = random.Random(1)
    pieces = chat_format.Template().controls() + ["\\", "[", "<", "x", "\n", "]", "/"]
    for _ in range(500):
        text = "".join(rng.choices(pieces, k=12))
        escaped = codec.escape(text)
        assert codec.unescape(escaped) == text
        assert not any(c in escaped for c in chat_format.Template().controls())
    turns = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", "[/INST]</s>"), (1, 2, "tool", "\\"), (None, None, None, "a"),
                                   (2, 0, "assistant", "b"), (2, 0, "assistant", "b")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in _rows(chat_format.read_chats(chat_format.format_chats(turns)))}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == digest("user\n\nassistant\n[/INST]</s>\ntool\n\\\n")
    assert got[1]["loss_sha256"] == digest("[/INST]</s>") and got[1]["n_invalid_turns"] == 1
    assert got[2]["n_turns"] == 2 and got[2]["n_invalid_turns"] == 2 and got[None]["n_turns"] == 1


def test_mix_comes_near_its_targets_and_is_bounded(spark):
    rows = _rows(QUERIES["op3_mixing"](spark, SMALL))
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sum(v[0]["target"] for v in by.values()) == pytest.approx(sum(r["size"] for r in rows))
    for v in by.values():
        assert abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 0.02 * v[0]["target"] + 64
    assert sorted(map(repr, rows)) == sorted(map(repr, _rows(QUERIES["op3_mixing"](spark, SMALL))))


def test_sainte_lague_gives_seats_by_highest_quotient(spark):
    weights, caps, seats = [53.0, 24.0, 23.0, 0.5, 7.7], [99, 99, 5, 99, 99], 37
    df = spark.createDataFrame([(f"s{i}", w, c, seats) for i, (w, c) in enumerate(zip(weights, caps))], "n string, w double, c long, s long")
    got = {r["n"]: r["q"] for r in _rows(mixing.sainte_lague(df, [], "n", "w", "s", "c", "q"))}
    held = [0] * 5
    for _ in range(seats):
        i = max((i for i in range(5) if held[i] < caps[i]), key=lambda i: weights[i] / (2 * held[i] + 1))
        held[i] += 1
    assert [got[f"s{i}"] for i in range(5)] == held


def test_base_rules_by_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in _rows(perplexity.perplexity_rules(spark.read.parquet(SMALL + "/documents.parquet")))}
    for d in documents:
        text = d["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_model_sums_to_one_and_the_join_agrees(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(
        ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "zzz qqq"] * 3)], DOC)
    tables = perplexity.estimate(perplexity.count_grams(docs, 3).cache(), 3)
    model = perplexity._collected(perplexity.model_table(tables), 3)
    for context in (b"th", b"he", b"qq", b"\x00\x01"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert np.exp(model.log_probs(grams, perplexity.language_key("en"))).sum() == pytest.approx(1, abs=1e-5)
    rules = lambda most: {r["doc_id"]: r["log_ppl"] for r in _rows(perplexity.perplexity_rules(docs, order=3, max_broadcast=most))}
    small, joined = rules(10**6), rules(0)
    assert small.keys() == joined.keys() and all(small[k] == pytest.approx(joined[k], abs=1e-5) for k in small)


def _scored(spark, rows):
    """Rows (lang, n_bytes, text_hash, log_ppl) as the scorer gives them, of texts that no base rule rejects."""
    return spark.createDataFrame([(i, lang, 100, 500, 0, 0, 0, h, n, x) for i, (lang, n, h, x) in enumerate(rows)],
                                 perplexity._STATS + ", text_hash long, n_bytes long, log_ppl double")


def _bands_by_brute_force(rows, least=20):
    """(middle, spread) of each (lang, class) from plain lists."""
    texts = {(lang, n.bit_length() - 1, h): (n, x) for lang, n, h, x in rows}
    pools = collections.defaultdict(list)
    for (lang, c, _), (n, x) in texts.items():
        for pool in ((lang, c), (lang,), ()):
            pools[pool].append(x)
    chosen = {(lang, c): next((p for p in ((lang, c), (lang,), ()) if len(pools[p]) >= least), None) for lang, c, _ in texts}
    if None in chosen.values():
        return {k: None for k in chosen}
    middle = {p: np.median(v) for p, v in pools.items()}
    away = {p: np.median(np.abs(np.array(v) - middle[p])) for p, v in pools.items()}
    usual = np.median([abs(x - middle[chosen[lang, c]]) * n ** 0.5 for (lang, c, _), (n, x) in texts.items()])
    return {k: (middle[p], max(away[p], usual / 2 ** ((k[1] + 0.5) / 2))) for k, p in chosen.items()}


def test_perplexity_bands_by_brute_force(spark):
    rng = random.Random(3)
    rows = [("en", 1500, i, rng.gauss(1.5, 0.02)) for i in range(40)]
    rows += [("en", 1500, 40, 1.52)] * 60 + [("en", 1600, 1000 + i, 1.5 + 1e-6 * i) for i in range(60)]  # copies and near copies
    rows += [("de", 600, i, rng.gauss(1.3, 0.03)) for i in range(50)] + [("de", 2500, i, rng.gauss(1.3, 0.01)) for i in range(90)]
    rows += [("de", 9000, 1, 1.31), ("de", 9000, 2, 1.29), ("de", 40_000, 3, 1.3), ("de", 40_001, 3, 5.0)]  # classes of one and two texts
    rows += [(None, 700, 1, 1.4), ("fr", 1100, 1, 4.0)]
    got = _rows(perplexity._verdict(_scored(spark, rows), 5.0, 8.0))
    want = _bands_by_brute_force([r for r in rows if r[3] != 5.0] + [("de", 40_001, 4, 5.0)])
    assert len(got) == len(rows)
    for r in got:
        lang, n, h, x = rows[r["doc_id"]]
        middle, spread = want[lang, n.bit_length() - 1]
        assert r["band_low"] == pytest.approx(middle - 5 * 1.4826 * spread, abs=0.01)
        assert r["band_high"] == pytest.approx(middle + 8 * 1.4826 * spread, abs=0.015)
        assert r["kept"] == (x not in (4.0, 5.0))  # nothing clean is lost to copies or to a small class; a stray text is


def test_perplexity_bands_do_not_collapse_over_copies(spark):
    rng = random.Random(4)
    clean = [("en", 1500, i, rng.gauss(1.5, 0.02)) for i in range(60)]
    bands = [{(r["band_low"], r["band_high"]) for r in _rows(perplexity._verdict(_scored(spark, clean + copies), 5.0, 8.0))}
             for copies in ([], [clean[0]] * 90)]
    assert bands[0] == bands[1] and len(bands[0]) == 1
    few = _rows(perplexity._verdict(_scored(spark, [("en", 1500, 1, 1.5), ("en", 1500, 2, 1.6)]), 5.0, 8.0))
    assert all(r["kept"] and r["band_low"] is None for r in few)


def test_perplexity_bands_reject_low_quality_of_held_out_labels(spark):
    """The widths were chosen on rows whose crc32 mod 3 is not 1 of another table; these are the others."""
    sf = SMALL.replace("0.001", "0.1")
    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(sf + "/labels.parquet").to_pylist()}
    rows = [(quality[r["doc_id"]], r["kept"]) for r in _rows(QUERIES["op4_perplexity_rules"](spark, sf))
            if not r["base_failed"] and r["doc_id"] in quality and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    bad, good = [k for q, k in rows if q == 0], [k for q, k in rows if q == 1]
    assert len(bad) >= 50 and len(good) >= 500
    assert bad.count(False) >= 0.4 * len(bad) and sum(good) >= 0.9 * len(good)


@pytest.mark.parametrize("page, want", [
    ("<p>Let <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> be</p>", "Let x+1 be"),
    ("<p>if <math><semantics><mrow><mtext>rate of</mtext> <mi>y</mi></mrow><annotation-xml>z</annotation-xml></semantics></math></p>",
     "if rate of y"),
    ("<p>a<svg><title>t</title><desc>d</desc><defs><text>no</text></defs><g><text>North</text><text x=1>South <tspan>pole</tspan></text></g>"
     "<style>q</style></svg>b</p>", "a North South pole b"),
    ("<p><math><mfrac><mn>1</mn><mn>2</mn></mfrac></math> <annotation>note</annotation> <desc>seen</desc></p>", "1/2 note seen"),
    ("<p>Size <select><option>S<option selected>M<option>L</select> now</p>", "Size M now"),
    ("<p>Size <select><optgroup label=g><option>S</option><option>M</option></optgroup></select> now</p>", "Size S now"),
    ("<p>Pick <select multiple><option>S<option>M</select></p>", "Pick S M"),
    ("<p>Save <span aria-hidden=true>now</span> <span hidden>no</span></p>", "Save now"),
])
def test_html_shows_formulas_labels_choices_and_aria_hidden(page, want):
    assert html_text.page_text(page) == want


def test_packing_keeps_every_id_in_one_place(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in _rows(QUERIES["op5_packing"](spark, SMALL)):
        docs[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    for d in documents:
        ids, at = np.array(tok.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4"), 0
        for r in sorted(docs[d["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in seqs.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_words_tokenise_as_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, words = Tokenizer.from_file(path), packing.WordTokens(path)
    texts = ["a" + chr(c) + "b " + chr(c) + "e" + chr(c) * 2 + " x" + chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts += ["it's 12,5%... <|endoftext|> dogs' THE!! x\x1cy", ""]
    for text, ids in zip(texts, words.encode(texts)):
        assert tok.encode(text, add_special_tokens=False).ids == ids.tolist()


def test_merging_by_ranks_equals_the_tokenizer(documents):
    """Each token merges to itself alone, in both libraries: then no other pair can make it. And all words agree."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, words = Tokenizer.from_file(path), packing.WordTokens(path)
    vocabulary = json.load(open(path, encoding="utf-8"))["model"]
    rank = {tuple(m): i for i, m in enumerate(vocabulary["merges"])}
    assert all(vocabulary["vocab"][a + b] == 512 + i for (a, b), i in rank.items())
    for token, i in vocabulary["vocab"].items():
        assert words.merger.encode_single_token(packing._token_bytes(token)) == i
        body = token.removesuffix("</w>")
        parts = list(body[:-1]) + [body[-1] + token[len(body):]]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: rank.get((parts[k], parts[k + 1]), len(rank)))
            assert (parts[best], parts[best + 1]) in rank, token
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
    every = sorted({w for d in documents for w in (d["text"] or "").split()})
    for w, e, ids in zip(every, tok.encode_batch(every, add_special_tokens=False), words.encode(every)):
        assert e.ids == ids.tolist(), w


def test_packing_holds_all_limits():
    limits = packing.Limits(tokens=64, segments=4, loss=20)
    packer, rng = packing.Packer(limits, 0), random.Random(3)
    total = 0
    for i in range(300):
        n = rng.choice([1, 2, 5, 30, 200])
        total += n
        packer.add(packing._Item(i, np.arange(n, dtype="<u4"), np.array([rng.random() < 0.4 for _ in range(n)], np.int64)))
    packer.drain(True)
    held = collections.defaultdict(lambda: [0, 0, 0])
    for r in packer.out:
        for k, v in enumerate((r[2], 1, r[7])):
            held[r[5]][k] += v
    assert sum(v[0] for v in held.values()) == total
    assert all(a <= 64 and b <= 4 and c <= 20 for a, b, c in held.values())


def test_html_layout():
    text = html_text.page_text
    assert text(None) == "" and text("") == "" and text("a < b") == "a < b"
    assert text("<p>one<p>two<br>three") == "one\n\ntwo\nthree"
    assert text("<ul><li>a<li>b<ol start=3><li>c</ol></ul>") == "- a\n- b\n  3. c"
    assert text("<table><tr><th>A<th>Bbb<tr><td>11<td>2</table>") == "A  | Bbb\n11 | 2"
    assert text("<div hidden>x</div><p style='display: none'>y</p><script>if(a<b)</script>z<noscript>n</noscript>") == "z"
    assert text("<pre>\n a\n  b</pre>") == " a\n  b"
    assert text("<div>" * 50_000 + "deep") == "deep"


def test_jaccard_across_blocks_equals_brute_force(spark):
    rng, docs = random.Random(5), []
    for g in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(60)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
            docs.append(" ".join(words))
    docs += ["", None, "a b", "a  b", "A B"]
    sets = [s.tolist() for s in jaccard_join.shingle_sets(docs)]
    parent = list(range(len(docs)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(set(sets[i]) & set(sets[j]))
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(5)
    for block in (1024, 8):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in _rows(jaccard_join.jaccard_components(df, block=block))}
        assert got == {i: (len(sets[i]), top(i)) for i in range(len(docs))}


def test_jaccard_of_oversize_tiles_and_long_sets_equals_brute_force(spark, monkeypatch):
    """One passage in all texts, texts of growing length (links across bands of size), long sets, small blocks and tiles."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(30))
    docs = []
    for length in (1, 40, 46, 52, 60, 69, 80, 93, 107, 1500, 1700):
        base = [f"b{length}x{rng.randrange(9**6)}" for _ in range(length)]
        for k in range(7):
            words = base[:length - rng.randrange(1 + length // 20)]
            docs.append(passage + " " + " ".join(words) if k else passage + " own" + str(length))
    grown = [f"g{i}" for i in range(400)]
    docs += [" ".join(grown[:n]) for n in range(40, 400, 6)]
    sets = [set(s.tolist()) for s in jaccard_join.shingle_sets(docs)]
    parent = list(range(len(docs)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(jaccard_join, "OUT_BYTES", 3000)
    monkeypatch.setattr(jaccard_join, "ZONE", 2)
    got = {r["doc_id"]: r["component_id"] for r in _rows(jaccard_join.jaccard_components(df, block=8, tile_rows=12))}
    assert got == {i: top(i) for i in range(len(docs))}


def _brute_components(docs, percent=85):
    sets = [set(s.tolist()) for s in jaccard_join.shingle_sets(docs)]
    least = list(range(len(docs)))
    moved = True
    while moved:
        moved = False
        for i in range(len(docs)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both and least[i] != least[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    least[i] = least[j] = min(least[i], least[j])
                    moved = True
    return dict(enumerate(least))


def test_jaccard_wide_signatures_part_very_long_texts(spark, monkeypatch):
    """Long texts that only share passages fill the short signatures; the wide ones part them and keep every link."""
    rng = random.Random(8)
    passages = [" ".join(f"q{k}x{i}" for i in range(30)) for k in range(6)]
    docs = []
    for n in (300, 520, 530, 1000, 1030, 1900, 2600):
        for _ in range(3):
            base = [f"v{rng.randrange(10**9)}" for _ in range(n)]
            rng.shuffle(passages)
            body = " ".join(base) + " " + " ".join(passages[:4])
            docs.append(body)
            if rng.random() < 0.7:
                docs.append(body + " " + " ".join(base[:n // 12]) + " tail")  # links
            docs.append(" ".join(base[:int(n * 0.8)]) + " " + passages[0])  # just too short to link, as a rule
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 1 << 14)
    monkeypatch.setattr(jaccard_join, "WIDE_SET", 256)
    monkeypatch.setattr(jaccard_join, "_LONG", 8)  # full for all of these
    cut = []
    forests = jaccard_join._tile_forests
    monkeypatch.setattr(jaccard_join, "_tile_forests", lambda *a: cut.append(a) or forests(*a))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    want = _brute_components(docs)
    got = {r["doc_id"]: r["component_id"] for r in _rows(jaccard_join.jaccard_components(df, block=8))}
    assert got == want and len(cut) == 2  # the tiles, then the clusters
    monkeypatch.setattr(jaccard_join, "SIG_BYTES", 1024)  # tiles that pass as a whole
    got = {r["doc_id"]: r["component_id"] for r in _rows(jaccard_join.jaccard_components(df, block=8))}
    assert got == want


def test_signatures_of_all_lengths_bound_the_overlap():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (3, 600, 1500, 2500, 5000, 70_000)]
    sets += [np.unique(np.concatenate((s[:-1], s[:1] + np.uint64(1)))) for s in sets]
    raw = [jaccard_join.wide_signature(s) or jaccard_join.signature(s).tobytes() for s in sets]
    assert [len(r) * 8 for r in raw[:6]] == [512, 512, 2048, 4096, 8192, 131_072]
    sigs = jaccard_join._Signatures(raw)
    for i, s in enumerate(sets):
        differing = sigs.differing(i, np.arange(len(sets)))
        for j, t in enumerate(sets):
            assert differing[j] <= len(np.setxor1d(s, t))
        assert differing[i] == 0


def test_workers_let_go_what_another_function_kept(spark):
    """Kept from task to task of one function, gone once the worker runs another one."""
    from chatsift.llm.common import arrow_map, kept

    def count(rows):
        for batch in rows:
            seen = kept("a test", list)
            seen.append(1)
            yield pa.RecordBatch.from_pydict({"n": [len(seen)]})

    def other(rows):
        yield from rows

    one = spark.range(1).select(F.col("id").alias("n")).coalesce(1)
    again = [[r["n"] for r in arrow_map(one, count, "n long", "a test").collect()] for _ in range(12)]
    assert max(again)[0] > 1  # workers are many, so not every task finds what another left
    assert arrow_map(arrow_map(one, other, "n long"), count, "n long").collect()[0]["n"] == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in _rows(components.connected_components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def _least_reachable(edges):
    least = {x: x for e in edges for x in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                moved = True
    return least


@pytest.mark.parametrize("chunk", [1 << 19, 1, 5])
def test_components_equal_brute_force_however_edges_are_cut(spark, monkeypatch, chunk):
    """Chains in any order of names, a hub, trees, edges twice and both ways, names below zero; tasks that hold few edges."""
    rng = random.Random(chunk)
    name = rng.sample(range(-10**12, 10**12), 400)
    edges = [(name[i], name[i + 1]) for i in range(90)] + [(name[100], name[100 + i]) for i in range(1, 90)]
    edges += [(name[200 + i], name[200 + rng.randrange(i)]) for i in range(1, 100)]
    edges += [(name[300 + rng.randrange(100)], name[300 + rng.randrange(100)]) for _ in range(60)]
    edges += [(b, a) for a, b in edges[::7]] + edges[::5]
    rng.shuffle(edges)
    want = {x: r for x, r in _least_reachable(edges).items() if any(a != b and x in (a, b) for a, b in edges)}
    monkeypatch.setattr(components, "CHUNK", chunk)
    got = _rows(components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4)))
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want


def test_components_run_few_stages(spark):
    """Small graphs cost the stages of the rounds: 12 for this one, 70 when each round grouped and joined both ends of all edges."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)], "a long, b long")
    sc = spark.sparkContext
    sc.setJobGroup("stages of components", "")
    try:
        assert components.connected_components(edges).count() == 71
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    infos = {k: tracker.getStageInfo(k) for j in tracker.getJobIdsForGroup("stages of components") for k in tracker.getJobInfo(j).stageIds}
    assert 0 < sum(1 for i in infos.values() if i and i.numCompletedTasks) <= 20


def test_jaccard_blocks_know_their_components(spark, monkeypatch):
    """Components are sought in tables for what tasks cannot know: tiles, and links between blocks; never links within one."""
    rng, docs, calls = random.Random(9), [], []
    for g in range(3):
        base = [f"g{g}x{i}" for i in range(80)]
        docs += [" ".join(base[:k] + [f"n{rng.randrange(10**6)}"] + base[k + 1:]) for k in rng.sample(range(80), 40)]
    seek = jaccard_join.connected_components
    monkeypatch.setattr(jaccard_join, "connected_components", lambda *a: calls.append(1) or seek(*a))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    for block, most in ((1024, 1), (8, 3)):
        calls.clear()
        got = {r["doc_id"]: r["component_id"] for r in _rows(jaccard_join.jaccard_components(df, block=block))}
        assert got == _brute_components(docs) and len(calls) <= most


@pytest.mark.parametrize("group_rows", [100_000, 8])
def test_suffix_dedup_equals_brute_force(spark, group_rows):
    rng = random.Random(7)
    rand = lambda n: "".join(rng.choices("abcdeé ", k=n))
    shared, edge = rand(90), rand(60)
    texts = [rand(rng.randrange(150)) + (shared[rng.randrange(30):] if i % 3 else "") + rand(50) + (edge if i % 4 == 0 else "") for i in range(60)]
    texts += ["ab" * 80, "x" * 100, "x" * 41, "abc", "", None, texts[0], texts[0], edge + edge]
    length, gram = 40, 8
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in _rows(suffix_dedup.remove_repeats(df, length=length, gram=gram, group_rows=group_rows))}
    for i, b in enumerate(raw):
        gone = {q for p in range(len(b) - length + 1) if count[b[p:p + length]] > 1 for q in range(p, p + length)}
        kept = bytes(c for p, c in enumerate(b) if p not in gone)
        assert (got[i]["n_removed"], got[i]["kept"]) == (len(gone), kept)
        assert got[i]["n_spans"] == sum(p in gone and p - 1 not in gone for p in range(len(b)))


def test_deep_shallow_orders_and_measures():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (200, 60)).astype(np.uint8)
    rows[50:90, :45] = rows[50, :45]
    rows[100:104] = rows[100]
    group = np.sort(rng.integers(0, 4, 200))
    order, shared = suffix_dedup.deep_shallow(rows, group, 0, shallow=16)
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys)
    for a, b, s in zip(keys, keys[1:], shared[1:]):
        common = next((k for k in range(60) if a[1][k] != b[1][k]), 60)
        assert s == (common if a[0] == b[0] else -1)


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        values = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        rice = exact_dedup.rice_bits(values) if n else 0
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, rice), len(values), rice) == values).all()


def test_exact_dedup_ties_and_repeats(spark, odd):
    rows = _rows(exact_dedup.exact_dedup(odd, owners=3))
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["text_sha256"]].append(r)
    for rs in groups.values():
        assert sum(r["kept"] for r in rs) == 1 and {r["group_size"] for r in rs} == {len(rs)}
        assert len({r["keep_id"] for r in rs}) == 1
    assert {r["keep_id"] for r in rows if r["doc_id"] in (4, 8)} == {4}
    assert [r["keep_id"] for r in rows if r["doc_id"] in (1, 2, 6)] == [6, 6, 6]


def test_classifier_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(path + "/labels.parquet").to_pylist()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in _rows(QUERIES["op10_quality_fm"](spark, path)) if r["held_out"] and r["doc_id"] in labels]
    for label in (0, 1):
        assert np.mean([p == q for p, q in held if q == label]) >= 0.9


def test_classifier_fits_each_label_once_and_within_its_bounds(spark, monkeypatch):
    seen = []
    fit = quality_fm.FactorisationMachine.fit
    monkeypatch.setattr(quality_fm.FactorisationMachine, "fit",
                        lambda self, rows, labels, *more: seen.append((rows, labels.tolist())) or fit(self, rows, labels, *more))
    rows = [(1, f"copy of one {i % 2}") for i in range(3000)] + [(2, "two is short"), (3, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    first = quality_fm.train(docs, labels, max_labels=100)
    again = quality_fm.train(docs.repartition(3), labels, max_labels=100)
    assert [s[1] for s in seen] == [[1.0, 0.0, 1.0]] * 2 and (first.linear == again.linear).all()
    sizes = [len(r[0]) for r in seen[0][0]]
    quality_fm.train(docs, labels, max_features=sum(sizes) - 1)
    assert 0 < len(seen[2][1]) < 3
    quality_fm.train(docs, labels, max_labels=2)
    assert len(seen[3][1]) == 2


def test_machine_uses_the_sum_of_squares_identity():
    model = quality_fm.FactorisationMachine(1)
    starts, index, value = quality_fm.Features().rows(["a b c a", None])
    margin, _ = model.margin(starts, index, value)
    for k in range(2):
        i, x = index[starts[k]:starts[k + 1]], value[starts[k]:starts[k + 1]]
        pairs = sum(x[a] * x[b] * model.pairs[i[a]] @ model.pairs[i[b]] for a in range(len(i)) for b in range(a))
        assert margin[k] == pytest.approx(model.bias + (model.linear[i] * x).sum() + pairs)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(SMALL + "/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from chatsift.session import work_path

        path = work_path(spark, "test")
        stage(spark, docs, SMALL).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == docs.columns, name
        docs = out
    rows = _rows(corpus_pipeline.run(spark, SMALL))
    assert 0 < docs.count() < before * 3 and {r["doc_id"] for r in rows} == {r["doc_id"] for r in _rows(docs)}
