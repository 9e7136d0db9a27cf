"""Language, chat, sentences, byte repeats, decontamination, shards and the pipeline."""

import hashlib
import random
import re
import zlib

import pytest

import corpus_pipeline
from tests.llm.helpers import prose
from tierline.llm import chat, decontamination, language, queries, sentences, shards, suffix


def test_language_held_out_accuracy(spark, sample):
    found = queries.op1_language(spark, sample).join(spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.collect() if r["held_out"]]
    assert rows and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_awkward_rows(spark, awkward):
    labelled = spark.createDataFrame([("the cat sat", "en"), ("le chat noir", "fr"), (None, "de"), ("12", "es"), ("x", None)], "text string, lang string")
    model = language.fit(labelled)
    assert sorted(model.by_language) == ["en", "fr"]
    found = language.identify(awkward, model).collect()
    assert len(found) == awkward.count()
    und = {r["doc_id"] for r in found if r["nearest"] == "und"}
    assert und == {0, 1, 2}
    empty = language.fit(labelled.limit(0))
    assert {r["nearest"] for r in language.identify(awkward, empty).collect()} == {"und"}
    assert language.choose({"b": 5, "a": 5}, 0.01) == ("a", 0.5, True)


def test_language_sample_is_the_least_hashes_of_each_language(spark):
    texts = [prose(k % 700, 12) for k in range(900)]
    labelled = spark.createDataFrame([(t, ("en", "fr")[k % 5 == 0]) for k, t in enumerate(texts)], "text string, lang string")
    by_hash = labelled.distinct().selectExpr("lang", "text", "xxhash64(text) as h").orderBy("h").collect()
    model = language.fit(labelled, sample_texts=40)
    for lang in ("en", "fr"):
        least = [r["text"] for r in by_hash if r["lang"] == lang][:40]
        assert model.by_language[lang] == language._plain(" ".join(least))


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    quoted = r"\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", quoted), (1, 1, "assistant", quoted), (1, 2, "assistant", "again <next> \\b\\\\l #"), (1, 3, "odd: # role", ""),
        (2, 1, None, None), (2, None, "assistant", "first"), (None, 0, "user", "x"), (2, 1, None, None), (3, 0, "user", "é" * 20_000),
    ]
    out = chat.formatted(turns(spark, rows))
    read = out.select("conv_id", "formatted", chat.turns_of(out["formatted"]).alias("turns"), chat.loss_text(out["formatted"], out["loss"]).alias("loss"))
    found = {r["conv_id"]: r for r in read.collect()}
    one = [(t["role"], t["text"]) for t in found[1]["turns"]]
    assert one == [(r, t) for c, _, r, t in rows if c == 1]
    assert found[1]["loss"] == quoted + "again <next> \\b\\\\l #"
    assert found[1]["formatted"].count(chat.HEAD) == 3 and found[1]["formatted"].count(chat.END) == 3
    assert [(t["role"], t["text"]) for t in found[2]["turns"]] == [("assistant", "first"), ("", ""), ("", "")]
    assert set(found) == {1, 2, 3, None} and found[3]["loss"] == ""
    assert chat.formatted(turns(spark, [])).count() == 0


def test_sentences_are_removed_where_a_run_stood_before(documents, awkward):
    run = "One two three four five six seven. Eight nine ten eleven twelve thirteen. And some more words here."
    docs = documents([f"Start of one. {run} End of one.", f"Other words. {run}\nOwn end.", run, "One two three four five six seven. Alone.", None, ""])
    found = {(r["doc_id"], r["first_sentence"], r["n_sentences"]) for r in sentences.repeated_sentences(docs).collect()}
    assert found == {(1, 1, 3), (2, 0, 3)}
    kept = {r["doc_id"]: r["text"] for r in sentences.drop_repeated_sentences(docs).collect()}
    assert kept[1] == "Other words. Own end." and kept[2] == "" and kept[0].endswith("End of one.") and kept[4] is None
    assert sentences.drop_repeated_sentences(awkward).columns == awkward.columns
    assert sentences.repeated_sentences(awkward.limit(0)).count() == 0


def test_repeated_sentences_equal_every_run(documents):
    rng = random.Random(9)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) + rng.choice(".!?") for _ in range(12)]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["Short one.", "Short one."]
    seen, gone = set(), set()
    for d, text in enumerate(texts):
        parts = re.split(r"(?<=[.!?]) ", text)
        n = len(parts)
        every = [(i, j) for i in range(n) for j in range(i + 2, n + 1) if len(" ".join(parts[i:j]).split()) >= 12] or [(0, n)]
        for i, j in every:
            run = tuple(parts[i:j])
            if run in seen:
                gone |= {(d, k) for k in range(i, j)}
            seen.add(run)
    texts += [texts[0]] * 40
    gone |= {(d, k) for d in range(62, 102) for k in range(len(re.split(r"(?<=[.!?]) ", texts[0])))}
    for hot in (0, 30, sentences.HOT):  # no head, some and all are broadcast
        found = sentences.repeated_sentences(documents(texts), hot=hot).collect()
        assert {(r["doc_id"], k) for r in found for k in range(r["first_sentence"], r["first_sentence"] + r["n_sentences"])} == gone
        places = sorted((r["doc_id"], r["first_sentence"], r["n_sentences"]) for r in found)
        assert all(a[0] < b[0] or a[1] + a[2] < b[1] for a, b in zip(places, places[1:], strict=False))
    assert gone and (61, 0) in gone


def brute_repeats(texts, size):
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            w = data[p : p + size]
            if w in seen:
                gone[p : p + size] = b"\1" * size
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return out


def test_transform_equals_sorted_suffixes():
    rng = random.Random(2)
    for _ in range(20):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 8))]
        bwt, lcp, owner = suffix.collection_transform(texts)
        order = [texts[x >> 10][len(texts[x >> 10]) - (x & 1023) :] for x in owner.tolist()]
        assert order == sorted(order) and len(set(owner.tolist())) == len(order)
        for a, b, n in zip(order, order[1:], lcp[1:].tolist(), strict=False):
            assert a[:n] == b[:n] and (len(a) == n or a[n : n + 1] != b[n : n + 1])
        for x, s in zip(owner.tolist(), bwt.tolist(), strict=True):
            before = len(texts[x >> 10]) - (x & 1023)
            assert s == (texts[x >> 10][before - 1] + 1 if before else 0)


@pytest.mark.parametrize("size", [12, 100])
def test_byte_repeats_equal_brute_force(spark, documents, size):
    rng = random.Random(size)
    passage = [prose(k, 30) for k in range(5)]
    texts = [" ".join(rng.choice(passage)[rng.randint(0, 40) :] if rng.random() < 0.6 else prose(rng.random(), 20) for _ in range(4)) for _ in range(30)]
    texts += [None, "", "a" * 700, "ab" * 300, "é" * 300, texts[0], texts[3] + "x"]
    found = {r["doc_id"]: r for r in suffix.without_repeats(documents(texts), size).collect()}
    for i, (n, gone, spans, kept) in enumerate(brute_repeats(texts, size)):
        got = found[i]["spans"] or []
        assert (found[i]["n_bytes"], sum(s["end"] - s["start"] for s in got), len(got), bytes(found[i]["kept"])) == (n, gone, spans, kept)
    few = {r["row_hash"]: r["spans"] for r in suffix.repeats(documents(texts), size, crowded=1).collect()}
    assert few == {r["row_hash"]: r["spans"] for r in suffix.repeats(documents(texts), size).collect()}


def test_byte_repeats_keep_rows_equal_in_every_column(spark):
    texts = [prose(1, 60), prose(2, 60) + prose(1, 40), "a" * 700, "short"]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0], rows[0], rows[1], rows[2], rows[3]], "doc_id long, text string")
    expected = {i: (spans, kept) for i, (_, _, spans, kept) in enumerate(brute_repeats(texts, 100))}
    found = suffix.without_repeats(docs).collect()
    assert sorted(r["doc_id"] for r in found) == [0, 0, 0, 1, 1, 2, 2, 3, 3]
    assert all((len(r["spans"] or []), bytes(r["kept"])) == expected[r["doc_id"]] for r in found)
    once = suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for crowded in (suffix.CROWDED, 1):
        assert sorted(suffix.repeats(docs, crowded=crowded).collect()) == sorted(once)


def test_byte_repeats_awkward_rows(awkward):
    assert suffix.without_repeats(awkward).count() == awkward.count()
    assert suffix.without_repeats(awkward.limit(0)).count() == 0


def test_reparameterised_questions_are_found_where_slots_agree(spark, documents, awkward):
    item = "If Anna buys 12 red apples and gives 5 apples to Ben, then Ben pays 3 dollars for every 12 kg that he was given today."
    same = item.replace("Anna", "Carl").replace("12", "40").replace("Ben", "Dora").replace("kg", "lb")
    loose = item.replace("Anna", "Carl").replace("12 kg", "13 kg").replace("12 red", "14 red")
    benchmark = spark.createDataFrame([(1, item), (2, "tiny Question 5"), (3, None), (4, "")], "item_id long, text string")
    docs = documents(["before " + item + " after", "text " + same, "text " + loose, "a tiny Thing 9", prose(1, 300), None, ""])
    found = {(r["doc_id"], r["item_id"], r["verbatim"]) for r in decontamination.contaminated(docs, benchmark).collect()}
    assert found == {(0, 1, True), (1, 1, False), (3, 2, False)}
    kept = {r["doc_id"] for r in decontamination.drop_contaminated(docs, benchmark).collect()}
    assert kept == {2, 4, 5, 6}
    assert decontamination.drop_contaminated(awkward, benchmark).count() == awkward.count()
    assert decontamination.drop_contaminated(awkward, benchmark.limit(0)).count() == awkward.count()
    assert decontamination.contaminated(awkward.limit(0), benchmark).count() == 0


def test_edited_partial_and_recased_items_are_found(spark, documents):
    text = prose(21, 39).replace(".", "")
    words = ("The " + text).split()
    words[25] = "The"
    item = " ".join(words)
    edited = " ".join([*words[:25], "One", *words[26:]])
    texts = [
        " ".join([*words[:20], "extra", *words[20:]]), " ".join(words[:22]), " ".join(words[18:]), item.lower(), item.upper(), edited,
        " ".join([*words[:20], "other", *words[21:]]), " ".join(words[:15]), prose(22, 400),
    ]
    docs = documents([f"{prose(k + 50, 30)} {t} {prose(k + 80, 30)}" for k, t in enumerate(texts)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: r for r in decontamination.contaminated(docs, benchmark).collect()}
    assert set(found) == set(range(7))
    # 40 words are 33 windows; a word put in is in the way of seven.
    assert found[0]["n_found"] == 26 and found[3]["n_found"] == found[4]["n_found"] == 33
    assert found[0]["verbatim"] and found[3]["verbatim"]


def test_tables_of_numbers_and_lists_of_names_match_by_words_only(spark, documents):
    numbers = lambda n, first: " ".join(str(first + 7 * k) for k in range(n))
    names = "Anna Ben Carl Dora Emil Fred Gina Hans Ida Jan Kurt Lea"
    story = "If Anna sells 12 red hats and 5 blue hats to her aunt then how many of the 17 hats are left with Anna at night?"
    benchmark = spark.createDataFrame([(1, numbers(30, 5)), (2, names), (3, "na " * 30), (4, story)], "item_id long, text string")
    texts = [
        numbers(60, 100_003), numbers(1000, 200_004), f"x {numbers(30, 5)} y", "Zoe Max Tom Tim Kim Jim Sam Pam Ron Don Lon Mon " * 50,
        f"by {names.lower()} too", "na " * 20_000, story.replace("Anna", "Mary Ann").replace("17", "19"),
    ]
    found = {(r["doc_id"], r["item_id"], r["verbatim"]) for r in decontamination.contaminated(documents(texts), benchmark).collect()}
    assert found == {(2, 1, True), (4, 2, True), (5, 3, True), (6, 4, False)}


def least_capacity(sizes, count):
    def parts(capacity):
        n, used = 1, 0
        for s in sizes:
            if used + s > capacity:
                n, used = n + 1, 0
            used += s
        return n

    return next(c for c in range(max(sizes), sum(sizes) + 1) if parts(c) <= count)


def test_shards_have_the_least_capacity(spark, documents, awkward):
    rng = random.Random(6)
    for count in (1, 3, 16):
        texts = [prose(rng.random(), rng.randint(1, 60)) for _ in range(150)] + ["same text"] * 30 + [None, "", "y" * 700]
        docs = documents(texts)
        found = shards.assigned(docs, count).collect()
        groups = {}
        for r in docs.selectExpr("xxhash64(coalesce(text, '')) as h", "octet_length(coalesce(text, '')) + 1 as n").collect():
            groups[r["h"] % (1 << 64)] = groups.get(r["h"] % (1 << 64), 0) + r["n"]
        held = {}
        for r in found:
            held.setdefault(r["shard"], []).append(r)
        assert max(sum(r["size"] for r in v) for v in held.values()) == least_capacity([groups[h] for h in sorted(groups)], count)
        assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in held.values())
        same = zlib.crc32(b"same text")
        assert len({r["shard"] for r in found if r["text_crc32"] == same}) == 1 and max(held) < count
    assert shards.assigned(awkward, 4).count() == awkward.count()
    assert shards.assigned(awkward.limit(0), 4).count() == 0


def test_pipeline_stages(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    names = docs.columns
    assert len(corpus_pipeline.STAGES) == 5
    rows = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sample).collect(), docs.schema)
        assert docs.columns == names
        rows.append(docs.count())
    assert rows == sorted(rows, reverse=True) and rows[-1] > 0
    packed = corpus_pipeline.run(spark, sample).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_chat_query_reads_back_what_went_in(spark, sample):
    said = {}
    for r in spark.read.parquet(f"{sample}/conversations.parquet").orderBy("turn").collect():
        said.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    for r in queries.op4_chat(spark, sample).collect():
        own = said.get(r["conv_id"]) or [(x, r"\### Assistant: </turn> ok") for x in ("user", "assistant")]
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
