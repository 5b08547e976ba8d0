"""Word lists and constants.

FIXED VALUES: the lexicons, labels, keywords and weights below must equal the ones the
enrichment is defined with, so results match. They are listed plainly, in their natural
order (category order matters: ties go to the earlier category).
"""

from __future__ import annotations

# ---- FIXED VALUES (begin) -------------------------------------------------------------

# Propaganda criteria: category -> phrases (substring match on lower-cased text).
PROPAGANDA = [
    ("accusatory_tone", ["fault of"]),
    ("opposition_distortion", ["enemies", "traitor", "dishonest", "corrupt"]),
    ("slogan_repetition", ["you have to believe", "the truth is", "don't forget", "do not forget"]),
    ("fear_appeals", ["danger", "threat", "crisis", "chaos"]),
    ("flagwaving", ["our nation", "homeland", "defend values"]),
    ("black_white_fallacy", ["either with us or against us", "only choice"]),
    ("clichés", ["golden times", "like once upon a time", "old times"]),
]

# Toxicity criteria: category -> phrases (substring match on lower-cased text).
TOXICITY = [
    ("insults", ["idiot", "stupid", "moron", "fool", "scum", "loser", "crooked", "degenerate", "ignoramus"]),
    ("threats", ["destroy", "kill", "eliminate", "eradicate", "you'll regret", "annihilate", "purge",
                 "defeat utterly"]),
    ("violent_language", ["blood", "war", "fight", "smash", "knock them out", "battle", "no quarter"]),
    ("divisive_statements", ["us vs them", "enemy of the people", "deep state", "traitors", "fifth column"]),
    ("personal_attacks", ["you always fail", "your fault", "worthless", "incompetent", "phony", "betrayer"]),
    ("exaggerations", ["always lie", "never truthful", "the worst", "greatest challenge",
                       "unprecedented threat"]),
    ("fear_appeals", ["danger", "threat", "crisis", "chaos", "they're coming for you", "crime wave"]),
    ("flagwaving", ["our nation", "homeland", "defend values", "make america great again", "fatherland",
                    "motherland", "maga"]),
]

# Persuasive words: category -> words (matched against whole tokens).
PERSUASION = [
    ("emotional", ["incredible", "amazing", "unique", "fantastic", "best", "exceptional", "unbelievable"]),
    ("urgency", ["now", "immediately", "instant", "quickly", "don't miss", "limited time"]),
    ("authority", ["experts", "proven", "scientifically", "research", "leaders", "professional"]),
    ("social_proof", ["everyone", "most", "majority", "common", "shared", "popular"]),
]

# Persuasion metric weights, in output order.
PERSUASION_WEIGHTS = [
    ("superlatives", 1.5),
    ("rhetorical_questions", 2.0),
    ("emotional_words", 2.5),
    ("urgency_words", 2.0),
    ("authority_words", 1.8),
    ("social_proof_words", 1.7),
]

# A search hit is a politician page when its first sentence contains one of these.
POLITICIAN_KEYWORDS = ["who", "politician", "statesman"]

# Classifier label orders.
SENTIMENT_LABELS = ["very negative", "negative", "neutral", "positive", "very positive"]
EMOTION_LABELS = ["sadness", "joy", "love", "anger", "fear", "surprise"]

# Sliding window defaults (words).
CHUNK_SIZE = 512
CHUNK_OVERLAP = 128

# Propaganda report: top types kept per speech.
TOP_TYPES = 5
# Keywords kept per speech.
TOP_KEYWORDS = 5

# Extracted metadata fields (order of the `$`-separated model response).
RESPONSE_FIELDS = ["speech_date", "speech_location", "speech_occasion", "topic", "cognitive_bias",
                   "summary", "keywords", "underlying_narrative"]

# ---- FIXED VALUES (end) ---------------------------------------------------------------

# Words ending in "est" that are not superlatives (our rule, not a tagger).
NOT_SUPERLATIVE = ["interest", "forest", "honest", "modest", "protest", "request", "suggest", "invest",
                   "harvest", "contest", "west", "rest", "test", "guest", "quest", "nest", "chest",
                   "vest", "pest", "arrest", "digest", "manifest", "conquest", "inquest", "detest",
                   "attest", "unrest", "behest", "earnest", "dishonest", "tempest", "priest", "midwest",
                   "northwest", "southwest", "lest", "zest", "jest", "crest", "wrest", "infest", "ingest",
                   "congest", "bequest"]
SUPERLATIVE_WORDS = ["most", "least", "best", "worst"]

# Second lexicon used by the checks: categories of frequent substrings so that ties, several
# types per speech and the top-5 cut are exercised on the driver tables (parameter, not data).
PROBE = [
    ("articles", ["the ", " le ", " la ", " der "]),
    ("conjunctions", [" and ", " et ", " und ", " y "]),
    ("suffix_tion", ["tion"]),
    ("suffix_ment", ["ment"]),
    ("syllable_ou", ["ou"]),
    ("syllable_er", ["er"]),
    ("syllable_que", ["que"]),
]

# Weighted lexicon used by the tone checks (parameter; the library lexicon is not shipped).
PROBE_TONE = [("the", 0.1), ("and", 0.3), ("of", 0.2), ("le", 0.7), ("la", 0.8), ("und", 0.9),
              ("tion", 0.6), ("er", 0.55)]

# Spark ML's default English stop words, as plain data (no file or jar access at run time).
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they",
    "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't",
    "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's",
    "when's", "where's", "who's", "why's", "would",
]


def stop_words(language: str = "english") -> tuple[str, ...]:
    """Stop words removed before term weighting (K1-K4); English is the documented default."""
    if language != "english":
        raise ValueError(f"no stop-word list for {language!r}; pass your own words instead")
    return tuple(ENGLISH_STOP_WORDS)
