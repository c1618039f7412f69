import tracemalloc
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer, models

from ebbline.llm import token_counts as tc

PATH = public_tokenizers.path(tc.VOCABULARY)


def brute(word, scores, lowest):
    """Best (score, -tokens) over all cuts."""
    text = tc.MARK + word
    best = [(0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = [(best[s][0] + scores[text[s:end]], best[s][1] - 1) for s in range(end) if text[s:end] in scores]
        char = text[end - 1]
        if char not in scores:
            options.append((best[end - 1][0] + lowest - 1_000_000 * tc.UNKNOWN_NATS, best[end - 1][1] - len(char.encode())))
        best[end] = max(options)
    return -best[-1][1]


def test_trie_counts_equal_brute_force_and_the_unigram_model():
    scores = tc.piece_scores(PATH)
    words = sorted({"the", "there", "therein", "thereinafter", "Straße", "漢字", "🙂🙂", "x" * 400, "a", "aaaaaaaaab", "<0x0A>", "don't", "ciónmente", "\x00\x01", "1234567890"})
    got = dict(tc.TrieCounter(scores).count(words))
    lowest = min(scores.values())
    assert got == {w: brute(w, scores, lowest) for w in words}
    model = Tokenizer(models.Unigram([("<unk>", 0.0)] + [(p, s / 1e6) for p, s in scores.items()], 0))
    for word in ("the", "there", "therein", "thereinafter", "ciónmente", "don't"):
        assert got[word] == len(model.encode(tc.MARK + word).ids)


def test_order_of_arrival_does_not_matter():
    scores = tc.piece_scores(PATH)
    words = ["b", "ab", "abc", "abd", "ab", "zz", "a"]
    one_by_one = {w: dict(tc.TrieCounter(scores).count([w]))[w] for w in words}
    assert dict(tc.TrieCounter(scores).count(sorted(words))) == one_by_one


def test_rows(spark, documents):
    scores = tc.piece_scores(PATH)
    lowest = min(scores.values())
    rows = [(1, "the there the"), (2, None), (3, ""), (4, " \t\n"), (None, "the"), (5, "the there the"), (5, "the there the"), (6, "w" * 50_000 + " é")]
    got = sorted(((r.doc_id or 0, r.n_pretokens, r.n_tokens) for r in tc.token_counts(documents(rows).withColumnRenamed("lang", "n_tokens"), PATH).collect()))
    want = sorted(((i or 0, len((t or "").split()), sum(brute(w, scores, lowest) if len(w) < 1000 else -1 for w in (t or "").split())) for i, t in rows))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g for g in got if g[0] != 6] == [w for w in want if w[0] != 6]
    assert tc.token_counts(documents([]), PATH).collect() == []


def test_scores_follow_ranks():
    scores = tc.piece_scores(PATH)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert "<unk>" not in scores and "<0x0A>" not in scores
    ordered = sorted(scores, key=scores.get, reverse=True)
    assert model.get_score(model.piece_to_id(ordered[0])) >= model.get_score(model.piece_to_id(ordered[100]))


def test_long_words_need_little_memory():
    counter = tc.TrieCounter({"▁": 0, "a": -1, "aa": -1, "b": -2})
    words = sorted(["a" * 200_000, "a" * 200 + "b", "b" * 200_000, "a", "ab"])
    alone = {w: dict(counter.count([w]))[w] for w in words}
    tracemalloc.start()
    assert dict(counter.count(words)) == alone
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()
