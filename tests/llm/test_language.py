from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from trilayer.llm import language
from trilayer.llm.language import KneserNey, Models, grams, identify, learn, points
from trilayer.llm.queries import op8_language

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string"
WORDS = {"x": "the cat sat on that mat and then the rat ran", "y": "der hund und die katze sind im haus"}


def rows_of(lang, n, seed):
    draw = np.random.Generator(np.random.PCG64(seed))
    own = WORDS[lang].split()
    return [" ".join(draw.choice(own, 40)) for _ in range(n)]


@pytest.fixture(scope="module")
def models(spark):
    rows = [(i, t, lang, "") for lang in WORDS for i, t in enumerate(rows_of(lang, 30, 1))]
    rows += [(99, None, "x", ""), (98, "text without a language", None, ""), (97, "", "z", "")]
    return learn(spark.createDataFrame(rows, DOCS))


def brute_force(codes, counts, order):
    """Interpolated Kneser-Ney from its definition, on tuples of symbols."""
    bits, mask = language.BITS, language.SYMBOLS - 1
    codes = [int(c) & (1 << 64) - 1 for c in codes]

    def tuple_of(code):
        return tuple(code >> bits * k & mask for k in range(order - 1, -1, -1))

    level = {order: Counter({tuple_of(c): n for c, n in zip(codes, counts)})}
    for n in range(order - 1, 0, -1):
        level[n] = Counter(g[1:] for g in level[n + 1])
    discount, totals, kinds = {}, {}, {}
    for n, grams_ in level.items():
        ones, twos = (sum(v == k for v in grams_.values()) for k in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5
        totals[n], kinds[n] = defaultdict(float), Counter(g[:-1] for g in grams_)
        for g, v in grams_.items():
            totals[n][g[:-1]] += v

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / language.SYMBOLS
        h = gram[:-1]
        if not kinds[n][h]:
            return p(gram[1:])
        seen = max(level[n][gram] - discount[n], 0) / totals[n][h]
        return seen + discount[n] * kinds[n][h] / totals[n][h] * p(gram[1:])

    return p, tuple_of


def test_model_equals_its_definition_and_sums_to_one():
    draw = np.random.Generator(np.random.PCG64(5))
    bits, symbols = language.BITS, draw.integers(0, 5, 400) * 16000
    code = sum(symbols[k : 397 + k].astype(np.int64) << bits * (3 - k) for k in range(4))
    assert code.min() < 0
    codes, counts = np.unique(code, return_counts=True)
    model = KneserNey(codes, counts)
    p, tuple_of = brute_force(codes.tolist(), counts.tolist(), 4)
    asked = np.concatenate([codes, draw.integers(-1 << 63, 1 << 63, 200)]).astype(np.int64)
    logs = model.log_probability(asked, 4)
    for c, log in zip(asked.tolist(), logs):
        assert log == pytest.approx(math.log(p(tuple_of(c & (1 << 64) - 1))), abs=1e-4)
    for history in (codes[0] >> bits, 12345):
        every = model.log_probability((int(history) << bits) + np.arange(1 << bits), 4)
        assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)


def test_sorted_hash_arrays(models):
    for model in models.models.values():
        for keys, values in (*model.grams, *model.contexts):
            assert (keys[1:] > keys[:-1]).all() and len(keys) == len(values)


def test_unseen_texts(spark, models):
    held = [(i, t.upper(), lang, "") for lang in WORDS for i, t in enumerate(rows_of(lang, 10, 2))]
    found = identify(spark.createDataFrame(held, DOCS), models).collect()
    assert [r["lang_pred"] for r in found] == [r["lang"] for r in found]
    assert not any(r["rejected"] for r in found)
    assert all(0.9 < r["score"] <= 1 for r in found)


def test_edges(spark, models):
    assert models.names == ["x", "y"]
    rows = [(1, None, "x", ""), (2, "", None, ""), (3, "123 !? \n", "x", ""), (4, "ⅷ 漢字", "x", ""),
            (5, "qzqz jxjx vkvk " * 30, "x", ""), (5, "the cat", None, ""), (5, "the cat", None, ""),
            (None, "die katze", "x", "")]
    docs = spark.createDataFrame(rows, DOCS)
    found = identify(docs, models)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score", "entropy", "rejected"]
    found = found.collect()
    assert [r["lang_pred"] for r in found[:3]] == ["und"] * 3
    assert all(r["rejected"] and r["score"] == 0 for r in found[:3])
    assert found[3]["lang_pred"] in ("x", "y")
    assert found[4]["rejected"]
    assert [r["lang_pred"] for r in found[5:]] == ["x", "x", "y"]
    assert identify(docs.limit(0), models).count() == 0
    nothing = learn(docs.limit(0))
    assert {r["lang_pred"] for r in identify(docs, nothing).collect()} == {"und"}


def test_long_texts_are_scored_whole(models, monkeypatch):
    texts = [" ".join(rows_of("x", 20, 3)), "the cat", None, " ".join(rows_of("y", 20, 4))]
    whole = models.entropies(texts)
    monkeypatch.setattr(language, "PIECE", 100)
    for a, b in zip(whole, models.entropies(texts)):
        assert np.allclose(a, b, rtol=1e-5)


def test_padding_and_runs_of_boundaries_do_not_count(models):
    table = language.symbol_of()
    pad = "\n" * 3
    _, _, counts = grams([pad + "the  cat\n"])
    assert counts.tolist() == [False] * 3 + [True] * 4 + [False] + [True] * 4
    assert table[points("T")[0]] == table[points("t")[0]] > 0
    assert isinstance(models, Models)
    assert [table[points(c)[0]] for c in "tжЖ漢7 \n"] == [ord("t"), ord("ж"), ord("ж"), ord("漢"), 0, 0, 0]
    far = [chr(0x10400), chr(0x10428), chr(0x20000), chr(0x20001)]
    found = [int(table[ord(c)]) for c in far]
    assert found[0] == found[1] and len(set(found)) == 3 and 0 not in found
    assert not any(chr(symbol).isalpha() for symbol in found)


#: Letters of scripts; the first two alone have more than 62.
SCRIPTS = {"latin": "abcdefghijklmnopqrstuvwxyzàâäçéèêëîïôöùûüñß", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
           "greek": "αβγδεζηθικλμνξοπρστυφχψω", "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
           "thai": "กขคงจชซญดตถทธนบปผพฟมยรลวสหอ", "hangul": "가나다라마바사아자차카타파하거너더러머버",
           "georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ"}


def script_texts(name, n, seed):
    """Words of the same lengths in every script; of the first two scripts many more."""
    draw = np.random.Generator(np.random.PCG64(seed))
    return [" ".join("".join(draw.choice(list(SCRIPTS[name]), k)) for k in draw.integers(3, 8, 40))
            for _ in range(n)]


def test_scripts_of_rarer_letters_differ(spark):
    learned = [name for name in SCRIPTS if name != "georgian"]
    rows = [(i, t, name, "") for k, name in enumerate(learned)
            for i, t in enumerate(script_texts(name, 90 if k < 2 else 24, 1))]
    found = learn(spark.createDataFrame(rows, DOCS))
    asked = [(i, t, name, "") for name in SCRIPTS for i, t in enumerate(script_texts(name, 8, 2))]
    for r in identify(spark.createDataFrame(asked, DOCS), found).collect():
        if r["lang"] == "georgian":
            assert r["rejected"]
        else:
            assert (r["lang_pred"], r["rejected"]) == (r["lang"], False)


def test_every_language_is_learned(spark, monkeypatch):
    names = ["cyrillic", "georgian", "greek", "hebrew", "latin"]
    rows = [(i, t, name, "") for k, name in enumerate(names)
            for i, t in enumerate(script_texts(name, 10 + 5 * k, 1))]
    docs = spark.createDataFrame(rows + [(0, None, None, ""), (1, "12", None, "")], DOCS)
    whole = {(r["lang"], r["text"]): r for r in identify(docs, learn(docs)).collect()}
    monkeypatch.setattr(language, "LANGUAGES", 2)
    blocks = learn(docs)
    assert [block.value.names for block in blocks.more] == [names[2:4], names[4:]]
    found = identify(docs, blocks)
    assert found.columns == ["doc_id", "text", "lang", *language.ADDED]
    for r in found.collect():
        other = whole[r["lang"], r["text"]]
        assert r["lang_pred"] == (r["lang"] or "und")
        assert (r["entropy"], r["rejected"]) == (other["entropy"], other["rejected"])
        assert r["score"] == pytest.approx(other["score"], rel=1e-9)


def test_copies_count_once_in_the_sample(spark):
    texts = rows_of("x", 100, 7)
    docs = spark.createDataFrame([(0, t, "x", "") for t in texts], DOCS)
    want = {r["text"] for r in language.sample_rows(docs, 40).collect()}
    first = language.sample_rows(docs, 1).first()["text"]
    more = docs.unionByName(spark.createDataFrame([(0, first, "x", "")] * 300, DOCS))
    found = language.sample_rows(more, 40).collect()
    assert len(found) == len(want) == 40 and {r["text"] for r in found} == want
    assert sorted(r["number"] for r in found) == list(range(1, 41))


def test_other_languages_letters_change_no_score(spark):
    rows = [(i, t, lang, "") for lang in WORDS for i, t in enumerate(rows_of(lang, 30, 1))]
    greek = [(i, t, "y" if i else "x", "") for i, t in enumerate(script_texts("greek", 12, 1))]
    asked = spark.createDataFrame([(0, t, "x", "") for t in rows_of("x", 5, 2)], DOCS)
    found = []
    for more in ([(i, t, "z", "") for i, t, _, _ in greek], [], [(0, SCRIPTS["thai"], "z", "")]):
        by = identify(asked, learn(spark.createDataFrame(rows + more, DOCS))).collect()
        found.append([r["entropy"] for r in by])
    assert found[0] == pytest.approx(found[1], abs=1e-9)
    assert found[0] == pytest.approx(found[2], abs=1e-9)


def test_long_texts_bound_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "CHARACTERS", 1000)
    docs = spark.createDataFrame([(0, t, "x", "") for t in rows_of("x", 100, 7)], DOCS)
    rows = sorted(language.sample_rows(docs, 90).collect(), key=lambda r: r["number"])
    assert language.LEAST <= len(rows) < 15
    assert sum(len(r["text"]) for r in rows[:-1]) <= 1000 or len(rows) == language.LEAST
    monkeypatch.setattr(language, "CHARACTERS", 1)
    assert language.sample_rows(docs, 90).count() == language.LEAST


def test_blocks_are_cut_by_size():
    sizes = [(name, 100 << 20) for name in "abcde"] + [("f", 300 << 20)]
    assert list(language._blocks(sizes)) == [["a", "b"], ["c", "d"], ["e"], ["f"]]
    assert list(language._blocks([])) == []


def test_whole_table(spark):
    rows = op8_language(spark, DATA).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet")
            .select("doc_id", "lang").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) > 0.98 * len(held)
    assert sum(r["rejected"] for r in rows) < 5
