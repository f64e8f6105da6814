"""Disguises that need word edges in the lattice, long tokens, and every sign that stands for a letter."""

import pytest

from listledger.llm import toxicity


@pytest.fixture(scope="module")
def chars(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return toxicity.CharModel.of_counts(toxicity.count_characters(docs, "text"))


def restored(text, chars):
    return {w for t in toxicity.tokens_of(text) for w in toxicity.restore(t, chars)}


def scorer(chars, *toxic):
    return toxicity.Scorer(toxicity.ToxicModel(chars, {f: 6.0 for w in toxic for f in toxicity.features_of(w)}))


@pytest.mark.parametrize("text,words", [("a l o s e r", ["loser"]), ("y o u i d i o t", ["idiot"]), ("a s t u p i d l o s e r", ["stupid", "loser"]), ("l o s e r, yes", ["loser"])])
def test_spaced_words_beside_others(chars, text, words):
    assert set(words) <= restored(text, chars)
    assert scorer(chars, *words).row(text)[0] > 4


@pytest.mark.parametrize("text,word", [("1d107", "idiot"), ("idio7", "idiot"), ("sh!7", "shit"), ("l-o-$-e-r", "loser"), ("a$$", "ass"), ("a$$hole", "asshole"), ("you_id10t!", "idiot"), ("stu" + "u" * 80 + "pid", "stupid")])
def test_every_sign_and_length(chars, text, word):
    assert word in restored(text, chars)


def test_long_runs_are_decoded_in_linear_time(chars):
    assert "stupid" in restored(" ".join("the people of the world and a stupid man in the house of the lord were here".replace(" ", "")), chars)
    assert len(toxicity.decode("l-0-5-e-r-" * 20_000, chars)) >= 60_000


@pytest.mark.parametrize("word", ["pathetic", "worthless", "disgusting", "stupid", "idiot", "disgrace"])
@pytest.mark.parametrize("joiner", [".", "-", "_", "..", "*"])
def test_words_spread_by_joiners(chars, word, joiner):
    assert word in restored(f"you {joiner.join(word)}, yes", chars)
    assert scorer(chars, word).row(f"you {joiner.join(word)}!")[0] > 4


def test_joined_letters():
    assert toxicity.joined_letters("so-p.a.t.h-x_y") == [list("pathxy")]
    assert toxicity.joined_letters("e.g") == toxicity.joined_letters("well-known") == toxicity.joined_letters("") == []


def every_division(steps, chars, margin):
    """The words of all divisions within the margin, each division written out."""
    def words(i):
        if i == len(steps):
            yield 0.0, ()
        for j in range(i + 1, min(i + toxicity.LONGEST, len(steps)) + 1):
            states = {0: (0.0, None)}
            for step in steps[i:j]:
                states = toxicity.advance(states, step, chars)
            for score, read in toxicity.ended(states, chars):
                for rest, others in words(j):
                    yield score + rest, ((i, j, toxicity.spelled(read)), *others)

    found = list(words(0))
    best = max(score for score, _ in found)
    return {w for score, ws in found if score >= best - margin for w in ws}


@pytest.mark.parametrize("run", ["aloser", "1d10tyes", "youidiot", "he!!oyou", "ss5aa"])
def test_divisions_against_all_divisions(chars, run):
    want = sorted(w for _, _, w in every_division(toxicity.spread_arcs(list(run)), chars, toxicity.SPREAD_MARGIN))
    assert sorted(toxicity.spread_words(list(run), chars)) == want


def test_long_words_and_long_spread_runs(chars):
    assert scorer(chars, "x" + "ab" * 40).row("x" + "ab" * 40)[0] > 4
    words = toxicity.restore("w.o.r.t.h.l.e.s.s." * 2_000, chars)
    assert words.count("worthless") >= 2_000
