"""Work that must not depend on how rows fall into tasks or on the size of the input."""

from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from reviewpulse.llm import fusion, parity, repair


def member_of(text):
    return int(parity.member_id(parity.set_id(parity.shingle_sets([text], parity.WordHashes())[0]), 0))


def test_near_copies_in_different_tasks_meet_over_texts_that_quote_them(spark):
    """A and B are near copies in different partitions; in each, a long text that is similar to none has their words."""
    rng = np.random.default_rng(5)
    missing, first, second = set(permutations("ABcd")), [], []
    while missing:
        word = iter(f"w{x}" for x in rng.integers(0, 10 ** 9, 200))
        common = [next(word) for _ in range(34)]
        texts = {"A": common, "B": [*common[:-1], next(word)], "c": [*common, *(next(word) for _ in range(30))],
                 "d": [*common, *(next(word) for _ in range(30))]}
        texts = {k: " ".join(t) for k, t in texts.items()}
        order = tuple(sorted(texts, key=lambda k: member_of(texts[k])))
        if order in missing:
            missing.remove(order)
            at = 10 * len(missing)
            first += [(at, texts["A"]), (at + 1, texts["c"])]
            second += [(at + 2, texts["B"]), (at + 3, texts["d"])]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(first + second, 2), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in parity.similar_groups(docs).collect()}
    assert got == {i: i - 2 if i % 10 == 2 else i for i, _ in first + second}


def test_rare_labels_stay_classes_on_large_inputs(frame):
    rows = [(i, "the cat and the dog of the house with this", "en") for i in range(2000)]
    rare = [(5000 + i, "η γάτα και ο σκύλος του σπιτιού", "el") for i in range(3)] + [(None, "кошка и собака в этом доме", "ru")]
    docs = frame(rows + rare, "id long, text string, lang string")
    model = fusion.train(docs, "id", "text", "lang", rows=20)
    assert model.classes == ["el", "en", "ru", "und"]
    found = fusion.identify(docs, model, "id", "text", F.col("lang"), F.lit(None).cast("string"))
    assert found.filter("declared <> language OR NOT accepted").count() == 0


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 50_000, 3000).astype(np.uint32)
    ids = np.concatenate([np.r_[passage, rng.integers(0, 50_000, 50)] for _ in range(40)]).astype(np.uint32)
    terminals, rules, left = repair.compress(ids)
    pairs = (left[:-1].astype(np.uint64) << np.uint64(32)) | left[1:]
    assert np.unique(pairs, return_counts=True)[1].max() < repair.LEAST_PAIRS
    # A passage that 40 documents have is about one symbol in each.
    assert len(left) < 40 * 60
    assert (repair.expand(left, terminals, rules) == ids).all()


def test_grammar_rounds_leave_no_frequent_pair_however_pairs_are_counted(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(150):
        ids = rng.integers(0, rng.integers(1, 6), rng.integers(0, 600)).astype(np.uint32)
        least = int(rng.integers(2, 30))
        monkeypatch.setattr(repair, "EXACT_PAIRS", int(rng.choice([0, 20, 1 << 18])))
        monkeypatch.setattr(repair, "COUNTERS", int(rng.choice([16, 64, 1 << 20])))
        terminals, rules, left = repair.compress(ids, least)
        assert (repair.expand(left, terminals, rules) == ids).all()
        pairs = (left[:-1].astype(np.uint64) << np.uint64(32)) | left[1:]
        assert len(left) < 2 or np.unique(pairs, return_counts=True)[1].max() < max(3, least)


def test_a_full_memory_of_pieces_changes_no_ids(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    from reviewpulse.llm import encoding

    monkeypatch.setattr(encoding, "HELD_PIECES", 20)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{w}{m}" for w, m in zip(rng.choice(["the", "Été", "word", "x1", "%%%"], 40), rng.choice(["", "!", "a", "9"], 40)))
             for _ in range(30)]
    for name, keeps_space in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        encoder, whole = encoding.Encoder(public_tokenizers.path(name), keeps_space), Tokenizer.from_file(public_tokenizers.path(name))
        for part in (texts[:10], texts[10:20], texts[20:] + texts[:10]):
            assert [x.tolist() for x in encoder.encode(part)] == [whole.encode(t, add_special_tokens=False).ids for t in part]
