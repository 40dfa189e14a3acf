"""Chat formatting, quality rules, tokens, language and quality scores."""

import hashlib
import random

import brute
import public_tokenizers
import numpy as np
import pytest
import tiktoken
from corpora import documents, filler
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabulon.llm import bytebpe, chat, langid, quality, queries, rules, wordcount

CHAT = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int"


def test_chat_reads_back_what_was_formatted(spark):
    hard = ["", None, "~", "~0", "<|end|>", "<|turn:user|>", "<|next|>", "<~1|", "</s>[INST] ok [/INST]", "a\nb|>c", "🙂 <| ~0~1"]
    roles = ["user", "assistant", "assistant", "sy|>stem", None]
    draw = random.Random(5)
    rows = [(c, t, draw.choice(roles), draw.choice(hard)) for c in range(40) for t in range(draw.randint(1, 9))]
    rows += [(7, 0, "user", "tie"), (7, 0, "user", "tie"), (None, None, "user", "no id")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], CHAT)
    read = {r["conv_id"]: r for r in chat.read_chats(chat.format_chats(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        got = [(b["role"], t) for b in read[conv]["blocks"] for t in b["texts"]]
        assert got == [(role, text) for _, _, role, text in own]
        blocks = [b["role"] for b in read[conv]["blocks"]]
        assert all(a != b for a, b in zip(blocks, blocks[1:]))
        trained = [text for _, _, role, text in own if role == "assistant"]
        assert read[conv]["loss_text"] == "".join(trained)
        formatted = read[conv]["formatted"]
        raw = "".join(formatted[s["start"] : s["start"] + s["length"]] for s in read[conv]["loss_spans"])
        assert raw.replace("<~1|", "<|").replace("~0", "~") == "".join(trained)
    assert chat.read_chats(chat.format_chats(turns.where("false"))).count() == 0


def test_quality_rules_match_brute_force(messy, messy_rows, nothing):
    found = rules.judged(messy).select("row.doc_id", "row.text", "m.*", "base_failed", "kept").collect()
    assert len(found) == len(messy_rows)
    for r in found:
        expected = brute.quality_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == expected
        assert not (r["kept"] and r["base_failed"])
    kept = rules.passing(messy)
    assert kept.columns == messy.columns and kept.count() == sum(r["kept"] for r in found)
    assert rules.passing(nothing).count() == 0


def test_quality_rules_repeated_windows(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a a a a a", "x a b c d e y a b c d e z", "a b c d\n" * 9, filler(8, 300) + " " + filler(8, 20)]
    docs = documents(spark, list(enumerate(texts)))
    for r in rules.judged(docs).select("row.text", "m.n_repeat_words", "m.n_dup_lines").collect():
        expected = brute.quality_counts(r["text"])
        assert (r["n_dup_lines"], r["n_repeat_words"]) == expected[3:5]


def test_rules_run_without_python(messy):
    plan = rules.passing(messy)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "é", "ñ", "Σ", "İ", "1", "²", "<|endoftext|>", "<|startoftext|>", "<|", "\x1c", "\x85", " ", "中", "🙂", "́", "A", "!", "aaaa", "_", "\x00"]
    return ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(400)] + ["a" * 20_000, "ab" * 9_000 + " " + "=" * 3_000]


def test_byte_bpe_equals_the_library(spark, messy_rows, odd_texts):
    texts = [t for _, t in messy_rows] + odd_texts
    docs = documents(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r for r in bytebpe.encoded(docs, queries.RANKS, public_tokenizers.PATTERN).collect()}
    with open(queries.RANKS, "rb") as file:
        ranks = bytebpe.Codec(file.read(), public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in enumerate(texts):
        assert list(got[i]["token_ids"]) == library.encode_ordinary(text or "")
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_byte_bpe_with_ranks_out_of_order():
    """A longer piece of lower rank than its parts: the rest of a bucket has to wait."""
    import base64

    pieces = [bytes([b]) for b in range(256)] + [b"abc", b"cab", b"ab", b"ca", b"abab", b"bc"]
    file = b"\n".join(base64.b64encode(p) + b" %d" % k for k, p in enumerate(pieces))
    codec = bytebpe.Codec(file, r"[a-z]+")
    library = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=codec.ranks, special_tokens={})
    draw = random.Random(9)
    for _ in range(300):
        text = " ".join("".join(draw.choices("abc", k=draw.randint(1, 14))) for _ in range(5))
        ids = codec.encode([text])[0]
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == library.encode_ordinary(text)


def test_a_worker_takes_few_pre_tokens_on(monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 60)
    monkeypatch.setattr(bytebpe, "TAKEN_ON", 20)
    with open(queries.RANKS, "rb") as file:
        ranks = file.read()
    small, fresh = (bytebpe.Codec(ranks, public_tokenizers.PATTERN) for _ in range(2))
    for k in range(6):
        texts = [filler(k, 30), filler(k + 50, 15)]
        ids = small.encode(texts)
        fresh.known.clear()
        assert ids == fresh.encode(texts) and [small.decode(i).decode() for i in ids] == texts
    first = list(small.known)[:20]
    assert list(small.forget()) == list(small.known) == first
    # A task leaves no more than that behind, also when it is stopped half way.
    coder = bytebpe.codec(ranks, public_tokenizers.PATTERN)
    work = bytebpe.remembering(coder, iter([filler(k, 60) for k in range(9)]), lambda t: coder.encode([t]))
    next(work)
    assert len(coder.known) > 20
    work.close()
    assert len(coder.known) == 20



def test_token_counts_equal_the_library(spark, messy_rows, odd_texts):
    texts = [t for _, t in messy_rows] + odd_texts
    docs = documents(spark, list(enumerate(texts)))
    library = Tokenizer.from_file(queries.WORD_BPE)
    for r in wordcount.token_counts(docs, queries.WORD_BPE, limit=50).collect():
        expected = len(library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids)
        assert r["n_tokens"] == expected and r["over_limit"] == (expected > 50)
        assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())


def test_row_operators_keep_every_row(messy, messy_rows, nothing):
    for made in (
        lambda d: bytebpe.digests(d, queries.RANKS, public_tokenizers.PATTERN),
        lambda d: wordcount.token_counts(d, queries.WORD_BPE),
        lambda d: langid.identify(d, langid.learn(d)),
        lambda d: quality.scored(d, 0.5),
    ):
        assert made(messy).count() == len(messy_rows)
        assert made(nothing).count() == 0


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.op5_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    assert found.where("score < 0 or score > 1").count() == 0


def test_language_without_letters(spark, messy):
    profile = langid.learn(messy)
    docs = documents(spark, [(1, None), (2, ""), (3, "123 ½ !?"), (4, "é")])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, profile).collect()}
    assert [got[k] for k in (1, 2, 3)] == ["und"] * 3 and got[4] == "en"


def test_language_filters_over_many_languages(spark):
    rows = [(k, filler(f"l{k}", 200, 40).replace("e", chr(97 + k % 26)), f"l{k:02}") for k in range(70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    profile = langid.learn(docs)
    assert len(profile.languages) == 70 and profile.masks.shape[1] == 2
    found = langid.identify(docs, profile).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() > 20


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op9_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out")
    by = {r["quality"]: r["p"] for r in found.groupBy("quality").agg(F.avg("predicted").alias("p")).collect()}
    assert by[1] > 0.9 and by[0] < 0.2


def test_quality_without_labels(spark, messy):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    model = quality.learn(messy, labels)
    assert model == 1.0
    both = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (12, 0), (10, 0)], "doc_id bigint, quality int")
    scores = [r["score"] for r in quality.scored(messy, quality.learn(messy, both)).collect()]
    assert all(0 <= s <= 1 for s in scores)


def test_quality_scores_match_plain_statistics_and_densities(spark, messy, messy_rows):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    given = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["quality"] in (0, 1)}
    plain = [(r["doc_id"], brute.quality_statistics(r["text"])) for r in docs.collect()]
    model = quality.learn(docs, spark.createDataFrame(list(given.items()), "doc_id bigint, quality int"))
    labelled = [(s, given[k]) for k, s in plain if k in given]
    rows = [*plain, *[(r[0], brute.quality_statistics(r[1])) for r in messy_rows]]
    expected = brute.discriminant_scores(labelled, [s for _, s in rows], quality.SHRINKAGE, quality.LEAST_VARIANCE, quality.MOST_LOG_ODDS)
    found = [(r["doc_id"], r["score"]) for d in (docs, messy) for r in quality.scored(d.select("doc_id", "text"), model).collect()]
    order = lambda pairs: np.array(sorted((-1 if k is None else k, s) for k, s in pairs))
    got, wanted = order(found), order((k, s) for (k, _), s in zip(rows, expected))
    assert got.shape == wanted.shape and np.abs(got - wanted).max() < 1e-6


def test_language_counts_match_plain_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    profile = langid.learn(docs)
    sets = brute.language_sets([(r["text"], r["lang"]) for r in rows if r["text"] and r["lang"]], langid.LEAST_COUNT, langid.RATE_SHARE)
    assert profile.languages == sorted(sets)
    found, close = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, profile).collect()}, 0
    for r in rows:
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        grams = brute.language_grams(r["text"])
        exact = np.array([sum(g in sets[lang] for g in grams) for lang in profile.languages])
        corrected = profile.counts(data, np.array([0, len(data)]))[0]
        # A filter never misses an n-gram; what it adds lies within its false positives, corrected by their mean.
        raw = corrected * (1 - profile.false) + len(grams) * profile.false
        slack = 6 * np.sqrt(len(grams) * profile.false + 1) + 2
        assert (raw >= exact - 1e-6).all() and (np.abs(corrected - exact) <= slack).all()
        order = np.sort(exact)
        if len(order) > 1 and order[-1] - order[-2] > 2 * slack.max():
            close += 1
            assert found[r["doc_id"]] == profile.languages[int(exact.argmax())]
    assert close > 0.8 * len(rows)
