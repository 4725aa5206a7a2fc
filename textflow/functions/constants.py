"""Fixed values.

Everything here is a fixed value that results depend on.  Tables are kept
small and are turned into broadcast DataFrames or literal maps by the
operators; nothing here grows with the data.
"""

from __future__ import annotations

# --- fixed values: English contractions and their expansions ---
CONTRACTIONS = [
    ("ain't", "are not"), ("aren't", "are not"), ("can't", "cannot"),
    ("couldn't", "could not"), ("didn't", "did not"),
    ("doesn't", "does not"), ("don't", "do not"), ("hadn't", "had not"),
    ("hasn't", "has not"), ("haven't", "have not"), ("isn't", "is not"),
    ("mightn't", "might not"), ("mustn't", "must not"),
    ("needn't", "need not"), ("shan't", "shall not"),
    ("shouldn't", "should not"), ("wasn't", "was not"),
    ("weren't", "were not"), ("won't", "will not"),
    ("wouldn't", "would not"), ("i'm", "I am"), ("i've", "I have"),
    ("i'll", "I will"), ("i'd", "I would"), ("you're", "you are"),
    ("you've", "you have"), ("you'll", "you will"), ("you'd", "you would"),
    ("he's", "he is"), ("he'll", "he will"), ("he'd", "he would"),
    ("she's", "she is"), ("she'll", "she will"), ("she'd", "she would"),
    ("it's", "it is"), ("it'll", "it will"), ("we're", "we are"),
    ("we've", "we have"), ("we'll", "we will"), ("we'd", "we would"),
    ("they're", "they are"), ("they've", "they have"),
    ("they'll", "they will"), ("they'd", "they would"),
    ("that's", "that is"), ("there's", "there is"), ("what's", "what is"),
    ("who's", "who is"), ("let's", "let us"), ("y'all", "you all"),
]

# --- fixed values: tokens the word tokenizer splits in two ---
TOKEN_SPLITS = [
    ("cannot", "can not"), ("gonna", "gon na"), ("gotta", "got ta"),
    ("wanna", "wan na"), ("gimme", "gim me"), ("lemme", "lem me"),
]

# --- fixed values: English stop-word list (179 words) ---
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your
yours yourself yourselves he him his himself she she's her hers herself it
it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after
above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn
couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't
isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# --- fixed values: suffix rules (class, suffix, replacement) in the order
# they are tried; a candidate is kept only when it is a known word ---
LEMMA_RULES = [
    ("n", "s", ""), ("n", "ses", "s"), ("n", "ves", "f"), ("n", "xes", "x"),
    ("n", "zes", "z"), ("n", "ches", "ch"), ("n", "shes", "sh"),
    ("n", "men", "man"), ("n", "ies", "y"),
    ("v", "s", ""), ("v", "ies", "y"), ("v", "es", "e"), ("v", "es", ""),
    ("v", "ed", "e"), ("v", "ed", ""), ("v", "ing", "e"), ("v", "ing", ""),
    ("a", "er", ""), ("a", "est", ""), ("a", "er", "e"), ("a", "est", "e"),
    ("r", "ily", "y"), ("r", "ly", ""),
]

# --- fixed values: Penn Treebank tag set (45 tags); order breaks ties,
# the first tag is the fallback tag ---
PTB_TAGSET = [
    "CC", "CD", "DT", "EX", "FW", "IN", "JJ", "JJR", "JJS", "LS",
    "MD", "NN", "NNS", "NNP", "NNPS", "PDT", "POS", "PRP", "PRP$",
    "RB", "RBR", "RBS", "RP", "SYM", "TO", "UH", "VB", "VBD", "VBG", "VBN",
    "VBP", "VBZ", "WDT", "WP", "WP$", "WRB", "$", "#", "``", "''", "(", ")",
    ",", ".", ":",
]

# --- fixed values: entity label codes; 9 is the padding label ---
NER_LABELS = [
    ("B-ORG", 0), ("O", 1), ("B-MISC", 2), ("B-PER", 3), ("I-PER", 4),
    ("B-LOC", 5), ("I-ORG", 6), ("I-MISC", 7), ("I-LOC", 8),
]
PAD_LABEL = 9
PAD_ID = 0
