"""Encoding, packing, fingerprints, language identification, scoring and personal data."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loomgrid.llm import byte_bpe, language_id, lm_scoring, merkle, packing, pii
from loomgrid.llm.common import hash_remainder

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["", " ", "  a  b", "\n\nx \n y", "x\n\n\ny", "a.b", "a\0b c.d", "don't. 's", "A.\nB,c", "é.é ²,³", "日本語テキスト", "x\t\ty", " lead", "trail ", "👩‍👩‍👧 ok", "a" * 3000, "it's we'LL 123, 4567. (x", "<|endoftext|> x<|startoftext|>y <| a|>b", "a|b, |c d|", "ΣΑΣ, İstanbul. ǅ,'s 's't", "naïve, ﬁ. Ⅷ, x²,y"]


def test_bpe_equals_library(texts):
    codec = byte_bpe.ByteBpe(RANKS, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    dice = random.Random(0)
    noise = ["".join(chr(dice.choice([dice.randrange(32, 127), dice.randrange(160, 0x2FFF), 32, 10])) for _ in range(60)) for _ in range(300)]
    for text in [*TRICKY, *noise, *texts.values()]:
        ids = np.frombuffer(codec.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert "".join(codec.stream(ids[i : i + 7] for i in range(0, len(ids), 7))) == text and codec.decode(ids) == text.encode()


def test_transducer_equals_merges():
    codec = byte_bpe.ByteBpe(RANKS, PATTERN)
    dice = random.Random(1)
    for _ in range(2000):
        piece = bytes(dice.choice(b"etaoinsh \xc3\xa9") for _ in range(dice.randrange(1, 14)))
        merged = [codec.ranks[t] for t in byte_bpe.merge_bytes(piece, codec.ranks)]
        assert np.frombuffer(codec.transducer.encode_piece(piece), "<u4").tolist() == merged


def test_the_last_byte_of_a_piece_makes_no_state():
    """Pieces that differ in their last byte only share all states, and have the ids of the definition."""
    codec = byte_bpe.ByteBpe(RANKS, PATTERN)
    whole = [b"qzvxkw" + bytes([b]) for b in b"abcdefghij"]
    found = [np.frombuffer(codec.transducer.encode_piece(p), "<u4").tolist() for p in whole]
    assert found == [[codec.ranks[t] for t in byte_bpe.merge_bytes(p, codec.ranks)] for p in whole]
    assert len(codec.transducer.states) <= 7 and codec.transducer.encode_piece(b"") == b""


def test_utf8_machine():
    for data in (b"\xff", b"\xc3", b"\xe2\x82", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"a\xc3\xa9b\x80", "€😀".encode()):
        machine = byte_bpe.Utf8Machine()
        text = "".join(machine.feed(bytes([b])) for b in data)
        text += machine.broken() if machine.need else ""
        assert text == data.decode(errors="replace"), data


def test_bpe_tables(odd, empty):
    rows = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in byte_bpe.round_trip(odd, RANKS, PATTERN).collect()}
    assert {(i, d) for i, _, d in rows} == {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd.collect()}
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(odd, RANKS, PATTERN), RANKS, PATTERN)
    assert sorted(map(str, back.collect())) == sorted(str(r) for r in odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    assert byte_bpe.round_trip(empty, RANKS, PATTERN).collect() == []


def test_word_tokenizer(texts):
    mine = packing.WordTokenizer(WORDS)
    for batch in (TRICKY, list(texts.values())):
        wanted = [e.ids for e in mine.tokenizer.encode_batch(batch, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(batch)] == wanted


def check_packing(rows, pieces, capacity=4096):
    tokenizer = packing.WordTokenizer(WORDS).tokenizer
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    want = defaultdict(list)
    for i, text in rows:
        want[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    for i, lists in want.items():
        if len(lists) == 1:
            ids, own = lists[0], sorted(by_doc[i], key=lambda p: p.start)
            assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist() and sum(p.length for p in own) == len(ids)
            for p in own:
                assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) and p.doc_tokens == len(ids)
        assert sum(p.length for p in by_doc[i]) == sum(map(len, lists))
    padding = total = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        n = sum(p.length for p in own)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist() and n <= capacity
        padding += 0 if n & (n - 1) == 0 else capacity - n
        total += n
    return padding, total


def test_packing(documents, odd, empty):
    for table in (documents.repartition(3), odd):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        padding, _ = check_packing(rows, packing.pack_documents(table, WORDS, window_sequences=4).collect())
        assert padding == 0
    assert packing.pack_documents(empty, WORDS).collect() == []
    ids = packing.pack_documents(documents.limit(3), WORDS, with_ids=True).first()
    assert len(ids.ids) == ids.length


def test_packing_balances_cost():
    packer = packing.Packer(64, 4, 1.0, 1.0, 0)
    for i in range(8):
        packer.add(i, 32)
    packer.finish()
    assert Counter(q for *_, q, _ in packer.closed) == {q: 2 for q in range(4)}


def test_merkle(documents, odd, empty, texts):
    for table in (documents.repartition(4), odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = sorted((r.doc_id, r.text or "") for r in table.collect())
        out = {r.doc_id: r for r in merkle.edit_trial(table, partitions=3).collect()}
        assert len(out) == len(rows)
        for k, (i, text) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            cut = len(text) // 4
            changed = text[: len(text) - cut] + following[:cut]
            r = out[i]
            assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(changed.encode()).hexdigest(), merkle.fingerprint(text), merkle.fingerprint(changed))
            assert r.near_edited == merkle.likeness(r.fingerprint, r.edited_fingerprint) and r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(following))
    assert merkle.edit_trial(odd).count() == odd.count() and merkle.edit_trial(empty).collect() == []
    trial = [r for r in merkle.edit_trial(documents).collect() if r.n_chars > 400]
    assert sum(r.near_edited > 0.5 for r in trial) > 0.95 * len(trial) and sum(r.near_next < 0.2 for r in trial) > 0.9 * len(trial)


def test_merkle_branches():
    text = "\n".join(f"Paragraph {i} has a few words. And one more sentence." for i in range(40))
    place = lambda x, y: merkle.edited_place(merkle.fingerprint(x), merkle.fingerprint(y))
    assert place(text, text) == "" and "".join(merkle.blocks(text)) == text
    assert place(text, text.replace("Paragraph 20 ", "Paragraph X ")) == "1.4.0-1.4.0"
    assert place(text, text.replace("Paragraph 3 ", "P ").replace("39 has a few words. And", "39 has a few words. But")) == "0.3.0-2.7.1"
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(text)) == 1.0


def test_language_id(documents, odd, empty):
    table = documents.withColumn("held_out", hash_remainder(F.col("doc_id"), 5) == 0)
    models = language_id.fit_languages(table.where("NOT held_out"))
    out = language_id.identify_languages(table, models, keep=["doc_id", "held_out", "lang"]).collect()
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in out)
    assert sum(r.rejected for r in out) <= 0.01 * len(out)
    strange = odd.sparkSession.createDataFrame([(1, "zzxqj qqzzk xxwvq " * 30), (2, None), (3, "123 !?")], "doc_id bigint, text string")
    judged = {r.doc_id: r for r in language_id.identify_languages(strange, models).collect()}
    assert all(judged[i].rejected for i in (1, 2, 3)) and judged[2].lang_pred == judged[3].lang_pred == "und" and judged[1].lang_pred in models.languages
    assert language_id.identify_languages(odd, models).count() == odd.count() and language_id.identify_languages(empty, models).collect() == []
    nothing = language_id.fit_languages(empty)
    assert {r.lang_pred for r in language_id.identify_languages(odd, nothing).collect()} == {"und"}


def test_kneser_ney_is_a_distribution():
    words = Counter({"anna": 3, "banana": 2, "nab": 1})
    models = language_id.LanguageModels({"x": language_id.gram_counts(words, 3)}, 3)
    letters = [language_id.BORDER, *map(ord, "abn")]
    for before in ([], list(map(ord, "b")), list(map(ord, "an")), list(map(ord, "nn"))):
        context = [language_id.BORDER, *before]
        total = 0.0
        for c in letters:
            codes = np.array([*context, c])
            total += 2 ** models._log2(codes, np.arange(len(codes)))[-1, 0]
        # what is missing is the uniform share of the unknown letter
        assert 0.9 < total < 1.0


def score_brute(rows, mu):
    words = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    train = [w for i, w in words if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c1, c2, h = Counter(), Counter(), Counter()
    for w in train:
        c1.update(w)
        c2.update(zip([b" ", *w], w, strict=False))
        h.update([b" ", *w[:-1]])
    z = sum(c1.values()) + len(c1) + 1
    out = []
    for i, w in words:
        base = [(c1[x] + 1) / z for x in w]
        full = [(c2[p, x] + mu * b) / (h[p] + mu) for p, x, b in zip([b" ", *w], w, base, strict=False)]
        out.append((i, len(w), sum(c1[x] > 0 for x in w), sum(c1.values()), sum(map(math.log10, base)), sum(map(math.log10, full))))
    return out


def test_scores(documents, odd, empty):
    for table in (documents, odd):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        found = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_scoring.score_documents(table, blocks=3).collect()]
        key = lambda r: (str(r[0]), r[1], r[2])
        for a, b in zip(sorted(found, key=key), sorted(score_brute(rows, 100.0), key=key), strict=True):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert lm_scoring.score_documents(empty).collect() == []


def test_packed_numbers():
    dice = np.random.default_rng(0)
    keys = np.unique(dice.integers(0, 1 << 63, 5000, dtype=np.uint64))
    assert (lm_scoring.unpack_sorted(lm_scoring.pack_sorted(keys)) == keys).all()
    for most in (1, 200, 70_000, 1 << 40):
        counts = dice.integers(0, most, 100)
        assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(counts)) == counts).all()
    assert len(lm_scoring.unpack_counts(lm_scoring.pack_counts(np.zeros(0, np.int64)))) == 0


def spans_brute(text):
    import re

    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_base_spans(texts):
    dice = random.Random(2)
    noise = ["".join(dice.choice("0123456789.-+@ ()aZ_%") for _ in range(80)) for _ in range(1500)]
    for text in [*noise, *texts.values(), "4111 1111 1111 1111 a.b@c.d@e.f 1.2.3.4.5.6.7.8 001.2.3.999"]:
        assert pii.base_spans(text) == spans_brute(text), text
    assert pii.base_spans("a" * 200_000 + "@x") == [] and pii.base_spans("1" * 200_000) == []


def test_personal_data(spark, documents, odd, empty):
    field = pii.fit_field(documents)
    found = pii.find_personal_data(documents, field).collect()
    clean = [r for r in found if not any((r.n_email, r.n_ip, r.n_card, r.n_phone))]
    assert sum(r.n_email for r in found) and len(clean) > 0.7 * len(found) and sum(r.spans != "" for r in clean) <= 0.01 * len(found)
    rows = [(1, "call +1 (988) 555-2485 today or later (988) 555-2485 please"), (2, "version 2.0 and 4.0 of 1999")]
    out = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"), field).collect()}
    assert out[1].n_phone == 1 and out[1].spans == "phone:5:22,phone:38:52" and out[2].spans == ""
    assert out[1].base_sha256 == hashlib.sha256(b"phone:5:22").hexdigest()
    masked = {r.doc_id: r.text for r in pii.mask_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"), field).collect()}
    assert masked[1] == "call [PHONE] today or later [PHONE] please" and masked[2] == rows[1][1]
    assert pii.find_personal_data(odd, field).count() == odd.count() and pii.find_personal_data(empty, field).collect() == []
    assert pii.fit_field(empty).skip > 0


def small_field():
    names = (("a",), ("b",))
    counts = Counter({(names[0], 0, -1, 0, ()): 6, (names[0], 0, 0, -1, (0,)): 5, (names[1], 1, 0, -1, (1,)): 7, (names[1], 1, -1, 1, (1, 1)): 3, (names[0], 1, 1, 0, ()): 1, (names[1], 4, 4, 4, (4,)): 2})
    return pii.SkipChainField(counts), counts


def enumerate_field(field, nodes):
    """Exact marginals over all labellings."""
    import itertools

    local = np.array([field.unary(x) for x in nodes])
    total = np.zeros((len(nodes), 5))
    for labels in itertools.product(range(5), repeat=len(nodes)):
        if any(x.label >= 0 and x.label != k for x, k in zip(nodes, labels, strict=True)):
            continue
        score = sum(local[i, k] for i, k in enumerate(labels) if nodes[i].label < 0) + sum(field.step[a, b] for a, b in zip(labels, labels[1:], strict=False))
        score += sum(field.skip for i, j in pii.skip_edges(nodes) if labels[i] == labels[j])
        for i, k in enumerate(labels):
            total[i, k] += math.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_field_agrees_with_enumeration():
    field, _ = small_field()
    for text, links, within in (("5551234 x 7771234567", 0, 1e-3), ("5551234567 x 1235551234567", 1, 1e-3), ("555123456 or 8881234 x 99555123456", 1, 0.05), ("+1 988 555 24850 now 55524850 so 9885552485 x 0955524850", 2, 0.05)):
        nodes = pii.mentions(text, pii.base_spans(text))
        assert len(pii.skip_edges(nodes)) == links, text
        assert np.allclose(field.marginals(nodes), enumerate_field(field, nodes), atol=within), text


def test_fit_climbs_the_pseudo_likelihood():
    """All weights together are at a maximum: no small step of any of them helps."""
    field, counts = small_field()

    def value(field):
        out = 0.0
        for (features, label, left, right, linked), n in counts.items():
            z = field.weights[-1] + sum(field.weights[field.index[f]] for f in features)
            z = z + (field.step[left] if left >= 0 else 0) + (field.step[:, right] if right >= 0 else 0) + field.skip * np.array([linked.count(k) for k in range(5)])
            out += n / sum(counts.values()) * (z[label] - np.log(np.exp(z).sum()))
        return out - 0.5 / sum(counts.values()) * ((field.weights**2).sum() + (field.step**2).sum() + (field.skip - 4.0) ** 2)

    field = pii.SkipChainField(counts, rounds=20_000)
    best = value(field)
    for name in ("weights", "step"):
        for at in np.ndindex(getattr(field, name).shape):
            for d in (-0.05, 0.05):
                getattr(field, name)[at] += d
                assert value(field) < best + 1e-7
                getattr(field, name)[at] -= d
    for d in (-0.05, 0.05):
        field.skip += d
        assert value(field) < best + 1e-7
        field.skip -= d


def test_spread_of_labels(documents):
    """Bare repeats of found mentions, by kind, however far away and many; other numbers stay."""
    field = pii.fit_field(documents)
    filler = " and so on with 12 things of 3 kinds"
    given = {"phone": ("+1 (988) 555-2485", "(988) 555-2485"), "card": ("4111 1111 1111 1111", "41111111 11111111"), "email": ("jo.doe@mail.org", "Jo.Doe@mail.org,")}
    for kind, (found, bare) in given.items():
        text = f"first {found}" + "".join(f"{filler} then {bare} again" for _ in range(40))
        spans = [x.split(":")[0] for x in pii.written(pii.base_spans(text) + field.added(text, pii.base_spans(text), 0.9)).split(",")]
        assert spans.count(kind) == 41 and set(spans) == {kind}, (kind, Counter(spans))


def test_json_is_whole():
    assert json.load(open(WORDS))["model"]["type"] == "BPE"


def naive_tree(text):
    """Sections of paragraphs of blocks, cut by hand."""
    sections, lines = [], text.split("\n")
    for k, line in enumerate(lines):
        if not sections or len(sections[-1]) == 16 or (not lines[k - 1].strip() and line.strip()):
            sections.append([])
        blocks, words, word, space = [], 0, 0, False
        current = ""
        ended = False
        for c in line:
            stop = c in ".!?。！？"
            # a sentence ends after its marks and the white space behind them
            if current and ended and not c.isspace() and not (stop and not current[-1].isspace()):
                blocks, current, words, word, space, ended = [*blocks, current], "", 0, 0, False, False
            if not c.isspace():
                fresh = not word or space or word == 32
                if fresh and words == 8:
                    blocks, current, words = [*blocks, current], "", 0
                word = 1 if fresh else word + 1
                words += fresh
            space = c.isspace()
            ended = ended or stop
            current += c
        sections[-1].append([*blocks, current] if current else blocks)
    return sections


def test_merkle_against_naive_cuts(texts):
    dice = random.Random(9)
    noise = ["".join(dice.choice("ab c.!\n?。字") for _ in range(dice.randrange(400))) for _ in range(300)]
    for text in [*noise, *texts.values(), "x" * 1000, "字" * 300 + "。" + "字" * 100, "", " ", "\n\n"]:
        sections = naive_tree(text)
        assert "\n".join("".join(p) for s in sections for p in s) == text
        digits = lambda b: hashlib.blake2b(b.encode(), digest_size=16).hexdigest()[:6]
        assert merkle.fingerprint(text).partition(":")[2] == ";".join(",".join("".join(map(digits, p)) for p in s) for s in sections)


def test_merkle_likeness_and_places(texts):
    dice = random.Random(10)
    own = [t for t in texts.values() if t]
    for text in own:
        a, b = sorted(dice.randrange(len(text) + 1) for _ in range(2))
        other = text[:a] + dice.choice(["", "Something else. ", "x"]) + text[b:]
        one, two = ([x for s in naive_tree(t) for p in s for x in p] for t in (text, other))
        marks = merkle.fingerprint(text), merkle.fingerprint(other)
        common = sum((Counter(one) & Counter(two)).values())
        assert merkle.likeness(*marks) == pytest.approx(2 * common / max(1, len(one) + len(two)) if text != other else 1.0)
        place = merkle.edited_place(*marks)
        assert (place == "") == (text == other)
        if place:
            (s, p, k), (s2, p2, _) = (tuple(map(int, x.split("."))) for x in place.split("-"))
            tree, changed = naive_tree(text), naive_tree(other)
            # all before the first block named is the same in both texts
            assert tree[:s] == changed[:s] and (len(changed) <= s or (tree[s][:p] == changed[s][:p] and (len(changed[s]) <= p or tree[s][p][:k] == changed[s][p][:k])))
            assert tree[s2 + 1 :] == changed[len(changed) - (len(tree) - s2 - 1) :] or len(changed) < len(tree) - s2
    assert merkle.likeness(merkle.fingerprint("字" * 4000), merkle.fingerprint("字" * 3000 + "x" * 1000)) > 0.65
