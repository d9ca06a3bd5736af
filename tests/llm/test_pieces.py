import pytest

from kinomill.llm import pieces

TEXTS = ["", " ", "a", "Hello  world\n\tx ", "the thin ▁ mark", "ﬁ①é 執 \x00a", "thinning tt", "▁", "  a  ▁▁ b", "x"]


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(n=4)


def every_path(codes, vocabulary):
    """All segmentations by recursion."""
    if not codes:
        yield 0.0, []
        return
    for k in range(1, min(len(codes), vocabulary.longest) + 1):
        span = codes[:k]
        i = None if pieces.LITERAL in span else vocabulary.ids.get("".join(map(chr, span)))
        if i is not None:
            own = (float(vocabulary.score[i]), [i])
        elif k == 1:
            spelled = vocabulary.byte_ids(span[0])
            own = (vocabulary.byte_score * len(spelled), spelled)
        else:
            continue
        for score, ids in every_path(codes[k:], vocabulary):
            yield own[0] + score, own[1] + ids


def test_round_trip_is_exact(encoder):
    ids, per_text, _, _ = encoder.encode(TEXTS)
    assert encoder.decode(ids, per_text) == TEXTS


def test_batch_equals_single_lattice_and_brute_force(encoder):
    texts = [t for t in TEXTS if 0 < len(t) <= 12]
    ids, per_text, scores, others = encoder.encode(texts)
    at = 0
    for text, n, score, more in zip(texts, per_text, scores, others):
        codes = pieces.codes_of([text])[0].tolist()
        paths = sorted((-s, p) for s, p in every_path(codes, encoder.vocabulary))
        best = [-s for s, _ in paths[:4]]
        found = pieces.n_best(codes, 4, encoder.vocabulary)
        assert [s for s, _ in found] == pytest.approx(best)
        assert [score, *(s for s, _ in more)] == pytest.approx(best)
        valid = {tuple(p): -s for s, p in paths}
        whole = pieces.segmentations(ids[at : at + n].tolist(), more)
        assert [valid[tuple(w)] for w in whole] == pytest.approx(best)
        assert len({tuple(w) for w in whole}) == len(whole)
        at += n


def test_rows(spark):
    docs = spark.createDataFrame([(1, "ab cd", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (None, "é" * 5000, "s")], "doc_id long, text string, ids string")
    got = {(r["doc_id"], r["n"]): r for r in pieces.encode(docs).selectExpr("*", "size(ids) as n").collect()}
    assert len(got) == 4
    assert all(r["decoded_equal"] for r in got.values() if r["ids"] is not None)
    none = [r for r in got.values() if r["doc_id"] == 2][0]
    assert none["ids"] is None and none["score"] is None and none["others"] is None
    assert [r["ids"] for r in got.values() if r["doc_id"] == 3] == [[]]
    assert pieces.encode(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["%%%", "&&&", "$$$", "rrrrñ", "von&&&", "%%% &&&", "a %%% b"])
def test_tied_words_keep_every_segmentation(encoder, text):
    ids, _, score, (more,) = encoder.encode([text])
    paths = list(every_path(pieces.codes_of([text])[0].tolist(), encoder.vocabulary))
    whole = pieces.segmentations(ids.tolist(), more)
    assert [score[0], *(s for s, _ in more)] == pytest.approx(sorted((s for s, _ in paths), reverse=True)[:4])
    assert len({tuple(w) for w in whole}) == len(whole)
    valid = {tuple(p): s for s, p in paths}
    assert [valid[tuple(w)] for w in whole] == pytest.approx([score[0], *(s for s, _ in more)])


def test_long_words_end(encoder):
    """One word of 100,000 signs, random or all equal, in time that grows with its length; n-best as by brute force on short ones."""
    import random
    import time

    rng = random.Random(4)
    for text in ("".join(rng.choice("abcdefgh\n中é") for _ in range(100_000)), "a" * 100_000):
        began = time.time()
        ids, per_text, scores, others = encoder.encode([text])
        assert encoder.decode(ids, per_text) == [text] and time.time() - began < 90
        assert len(others[0]) == 3 and all(s <= scores[0] + 1e-6 for s, _ in others[0])


def test_ties_go_to_smaller_ids(encoder):
    for text in ("%%%%", "aaaaaaa", "rrrrñ", "$$$$$", "\n\n\n"):
        codes = pieces.codes_of([text])[0].tolist()
        paths = sorted((round(-s, 9), p) for s, p in every_path(codes, encoder.vocabulary))
        found = pieces.n_best(codes, 4, encoder.vocabulary)
        assert [p for _, p in found] == [p for _, p in paths[:4]]
