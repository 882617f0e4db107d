"""Quality rules, decontamination, encoding, token files and chat formatting."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
import tiktoken
from vecloom.llm import byte_bpe, chat, tokens_file
from vecloom.llm.common import flat
from vecloom.llm.decontaminate import benchmark_hits, contaminated, drop_contaminated
from vecloom.llm.pieces import PieceCoder
from vecloom.llm.quality import drop_low_quality, measure, quality_measures

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_texts(seed: int, many: int = 300) -> list:
    r = random.Random(seed)
    units = [" ", "  ", "\n", "\n\n", "a", "É", "́", "b1", "'s", "don't", "日", "!", "÷", "\U0001F600", "\u0085", " ", "\x1c", "12", "<|endoftext|>", "ß "]
    return [None, "", " ", "  a  b", "a ", " a", "\n", "　 x"] + ["".join(r.choice(units) for _ in range(r.randint(1, 60))) for _ in range(many)]


def test_quality_equals_brute_force():
    r = random.Random(1)
    texts = odd_texts(1, 50) + ["a b c d e a b c d e", "x\nx\nx\n \n ", "x y z " * 40] + [
        "".join(r.choice(["a ", "b ", "é\n", "c# ", "\x0b", "dd "]) for _ in range(r.randint(0, 90))) for _ in range(150)]
    found = measure(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        text = text or ""
        words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
        windows = Counter(tuple(words[j:j + 5]) for j in range(len(words) - 4))
        under = {k for j in range(len(words) - 4) if windows[tuple(words[j:j + 5])] > 1 for k in range(j, j + 5)}
        longest = 0
        for a in range(len(words)):
            for b in range(a):
                n = 0
                while a + n < len(words) and words[a + n] == words[b + n]:
                    n += 1
                longest = max(longest, n)
        failed = len(words) < 10 or 100 * len(under) > 20 * len(words)
        wanted = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(under), longest if longest >= 5 else 0, failed)
        assert tuple(found[k][i] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "base_failed")) == wanted, text
        assert not (failed and found["kept"][i])
        fair = longest <= 100
        for least, most in ((5, 15), (6, 14), (7, 13), (8, 12), (9, 11), (10, 10)):
            counts = Counter(tuple(words[j:j + least]) for j in range(len(words) - least + 1))
            inside = {k for j in range(len(words) - least + 1) if counts[tuple(words[j:j + least])] > 1 for k in range(j, j + least)}
            chars = sum(len(words[k]) for k in inside)
            fair &= 100 * chars <= most * sum(map(len, words))
        assert found["long_repeat_chars"][i] == chars and bool(found["kept"][i]) == (fair and not failed)


def test_long_repeats_decide_where_the_base_rule_does_not():
    """Two texts that pass the base rule: one says a passage of eleven words twice, one repeats five long words among short ones."""
    plain = " ".join(f"w{i}" for i in range(98))
    passage = " ".join(f"p{i}" for i in range(11))
    long_words = " ".join("x" * 40 + str(i) for i in range(5))
    texts = [f"{passage} {plain} {passage}", f"{long_words} {plain} {long_words}", f"{plain} p1 p2 p3 p4 p5 {plain.replace('w', 'v')} p1 p2 p3 p4 p5"]
    found = measure(pa.array(texts))
    assert found["base_failed"].tolist() == [False] * 3 and found["kept"].tolist() == [False, False, True]


def test_quality_keeps_varied_text_and_drops_repeats(spark):
    varied = " ".join(f"w{i}" for i in range(900))
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(1, varied, "a", 1), (1, varied, "a", 1), (2, varied + passage + " x " + passage + varied.replace("w", "v"), None, 2), (3, None, "c", 3), (None, "", "d", 4)]
    docs = spark.createDataFrame(rows, SCHEMA + ", kept string, n_words int")
    assert [tuple(r) for r in drop_low_quality(docs).collect()] == rows[:2]
    assert {(r.doc_id, r.base_failed, r.kept) for r in quality_measures(docs).collect()} == {(1, False, True), (2, False, False), (3, True, False), (None, True, False)}
    assert quality_measures(docs.limit(0)).count() == 0


def hit_model(text, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    words, hit, named = cut(text), set(), set()
    for name, item in items:
        own = cut(item)
        size = min(13, len(own))
        windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if size else set()
        for p in range(len(words) - size + 1):
            if tuple(words[p:p + size]) in windows:
                hit |= set(range(p, p + size))
                named.add(name)
    return len(words), len(hit), sorted(named)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination_equals_brute_force(spark, block_bytes):
    r = random.Random(2)
    v = [f"W{i}é" for i in range(12)] + ["a-b", "c"]
    items = [(str(i), " ".join(r.choice(v) for _ in range(n))) for i, n in enumerate([3, 20, 13, 14, 0, 2, 40, 13])] + [("1", "W1é W2é again"), ("", None)]
    texts = [" ".join(r.choice(v) for _ in range(r.randint(0, 60))) for _ in range(60)] + [None, "", "?!", items[6][1] + " x"]
    texts += [texts[3] + " " + items[1][1].lower(), items[1][1][5:]]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], SCHEMA + ", n_hit int")
    bench = spark.createDataFrame([(int(n) if n else None, t) for n, t in items], "item_id long, text string")
    found = benchmark_hits(docs, bench, block_bytes=block_bytes).withColumn("c", contaminated()).collect()
    kept = {r.doc_id for r in drop_contaminated(docs, bench).collect()}
    for row in found:
        n_words, n_hit, names = hit_model(texts[row.doc_id], items)
        assert (row.n_words, row.n_hit, row.item_ids, row.c) == (n_words, n_hit, names, n_hit > 0 and 20 * n_hit >= n_words)
        assert (row.doc_id in kept) != row.c
    assert drop_contaminated(docs, bench).columns == docs.columns
    assert benchmark_hits(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0 and benchmark_hits(docs.limit(0), bench).count() == 0


@pytest.fixture(scope="module")
def definition():
    return byte_bpe.multilingual()


def test_byte_bpe_encodes_as_the_rank_file_and_decodes_back(definition, small):
    import pyarrow.parquet as pq

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts(3, 2000) + pq.read_table(f"{small}/documents.parquet")["text"].to_pylist()
    coder = PieceCoder(Tokenizer.from_str(definition), byte_bpe.stands_alone, "")
    ids, bounds = coder.encode(*byte_bpe.safe_cuts(*flat(pa.array(texts, pa.string()))))
    data, ends = byte_bpe.decode(ids, bounds, pa.array(byte_bpe.byte_table(definition), pa.large_binary()))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == other.encode_ordinary(text or "")
        assert data[ends[i]:ends[i + 1]].tobytes() == (text or "").encode()


def test_byte_bpe_frames(spark, definition):
    rows = [(1, "né 日本 né", 5), (1, "né 日本 né", 5), (None, None, None), (2, "", 7)]
    docs = spark.createDataFrame(rows, SCHEMA + ", ids int")
    found = byte_bpe.decoded(byte_bpe.encoded(docs, definition), definition).collect()
    assert sorted((bytes(r.decoded).decode() for r in found)) == ["", "", "né 日本 né", "né 日本 né"]
    offsets = {r.doc_id: r for r in byte_bpe.encoded_with_offsets(docs, definition).collect()}
    text = rows[0][1]
    assert "".join(text[a:b] for a, b in dict.fromkeys(zip(offsets[1].start, offsets[1].end))) == text and offsets[2].token == []
    assert byte_bpe.digests(docs.limit(0), definition).count() == 0


def test_codes_give_any_token():
    r = np.random.default_rng(0)
    for ids in (np.array([], np.uint32), np.array([0]), np.array([255, 256, 2**32 - 1, 65536, 3]), r.integers(0, 70000, 5000), r.integers(0, 200, 513)):
        codes = tokens_file.pack(ids)
        places = r.integers(0, len(ids), 200) if len(ids) else np.zeros(0, np.int64)
        assert (tokens_file.unpack(codes) == ids).all() and (tokens_file.pick(codes, places) == ids[places]).all()
    with pytest.raises(IndexError):
        tokens_file.pick(codes, np.array([513]))


def test_token_file_holds_the_ids_of_whole_texts(spark, tmp_path):
    texts = odd_texts(4, 150) + ["word " * 500]
    docs = [(3 * i % 101 if i % 50 else None, t) for i, t in enumerate(texts)]
    path = f"file://{tmp_path}/tokens"
    tokens_file.write_tokens(spark.createDataFrame(docs, SCHEMA).repartition(4), tokens_file.word_tokenizer(), path, block_tokens=100)
    whole = Tokenizer.from_str(tokens_file.word_tokenizer())
    stream, wanted = [], []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        wanted.append((doc_id, len(stream), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        stream += ids
    found = [tuple(r) for r in tokens_file.read_documents(spark, path).collect()]
    assert sorted(found, key=lambda r: r[1]) == wanted
    places = [0, 1, len(stream) // 2, len(stream) - 1]
    asked = spark.createDataFrame([(p,) for p in [*places, places[0], 10**9, -1, None]], "place long")
    assert sorted(map(tuple, tokens_file.read_tokens(spark, path, asked).collect())) == [(p, stream[p]) for p in sorted(set(places))]
    assert tokens_file.read_tokens(spark, path, asked.limit(0)).count() == 0


def test_empty_token_file(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    tokens_file.write_tokens(spark.createDataFrame([], SCHEMA), tokens_file.word_tokenizer(), path)
    assert tokens_file.read_documents(spark, path).count() == 0


def test_control_strings_are_escaped_and_come_back(spark):
    texts = ["</s>[INST] ok [/INST]", r"<\s> [\INST] [\\/INST] <\\\/s>", "<", "[", "\\", "<s", "", "<s><s>[INST]", "a\nb</s"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in rows)
    assert not any(c in r.e for r in rows for c in (chat.OPEN, chat.MIDDLE, chat.CLOSE, "[/INST]"))


def test_best_branches_of_reply_trees(spark):
    tree = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 2.0), ("t", 4, 3, 9.0), ("t", 5, 3, 9.0), ("t", 6, 2, 0.5),
            ("u", 1, 99, 0.0), ("loop", 1, 2, 1.0), ("loop", 2, 1, 1.0)] + [("long", i, i - 1 if i else None, 1.0) for i in range(37)]
    frame = spark.createDataFrame(tree, "tree string, id long, parent long, score double")
    found: dict = {}
    for row in chat.best_branches(frame, 2).orderBy("tree", "rank", "depth").collect():
        found.setdefault((row.tree, row.rank), []).append(row.id)
    assert found == {("t", 1): [1, 3, 4], ("t", 2): [1, 3, 5], ("u", 1): [1], ("long", 1): list(range(37))}


def test_conversations_round_trip(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "[INST]\\ yes"), (1, 1, "assistant", "again"), (1, 1, "assistant", "again"), (2, None, None, None),
            (None, 3, "assistant", ""), (3, 0, "[INST]<s>", "x</s><s>y[INST]z")]
    messages = chat.chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {r.tree: r for r in chat.parsed(chat.format_trees(messages)).collect()}
    assert [tuple(t) for t in found["1"].turns] == [("user", "hi </s>"), ("assistant", "[INST]\\ yes"), ("assistant", "again"), ("assistant", "again")]
    assert found["1"].trained == ["[INST]\\ yes", "again", "again"]
    assert [tuple(t) for t in found["2"].turns] == [("", "")] and found["2"].trained == []
    assert found[""].trained == [""] and [tuple(t) for t in found["3"].turns] == [("[INST]<s>", "x</s><s>y[INST]z")]
    assert chat.format_trees(messages.limit(0)).count() == 0
