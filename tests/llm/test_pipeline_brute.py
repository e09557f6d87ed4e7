"""The whole pipeline against a brute-force version of its five stages."""

from capstan.llm import quality_llr
from capstan.llm.common import table
from tests.llm.conftest import LOWER, SF, split_words
from tests.llm.test_text_operators import brute_base, brute_components, brute_edits, brute_llr, brute_repeats


def trigrams(words):
    return set(zip(words, words[1:], words[2:]))


def test_pipeline_matches_brute_force(spark):
    import public_tokenizers
    import sentencepiece

    import corpus_pipeline
    rows = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    good = {r.doc_id for r in table(spark, SF, "labels").collect() if r.quality == 1}
    # 1. base rules and likelihood ratio
    ids = sorted(rows)
    llr = brute_llr([rows[i] for i in ids], [rows[i] for i in ids if i in good], quality_llr.NGRAM, quality_llr.BITS, quality_llr.THRESHOLD)
    kept = {i: rows[i] for i, s in zip(ids, llr) if not brute_base(rows[i])[-1] and s >= quality_llr.THRESHOLD}
    # 2. one document of each group (five-word shingles)
    group = brute_components(list(kept.items()), 5)
    kept = {i: t for i, t in kept.items() if group[i][0] == i}
    # 3. passages that a smaller document has
    kept = {i: text if gone else kept[i] for i, _, gone, text in brute_repeats(list(kept.items()))}
    # 4. benchmark items within a fifth of their words; such a match keeps three words of the item in a row
    items = [split_words(r.text.translate(LOWER)) for r in table(spark, SF, "benchmark").collect()]
    clean = {}
    for i, t in kept.items():
        w = split_words(t.translate(LOWER))
        mine = trigrams(w)
        # (an item of fewer words may keep no three in a row)
        if not any((len(x) < 8 or trigrams(x) & mine) and set(x) & set(w) and brute_edits(w, x) <= int(0.2 * len(x)) for x in items if x):
            clean[i] = t
    # 5. ids and what they decode to
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: (sp.encode(t, add_bos=True, add_eos=True), sp.decode(sp.encode(t))) for i, t in clean.items()}
    got = {r.doc_id: (list(r.ids), r.text) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(want) < len(rows)
