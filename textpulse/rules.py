"""Domain values the results depend on; every function that uses them takes an override."""

# --- Fixed values -----------------------------------------------------------
# Topic categories and their keywords. Order matters: the first category wins.
TOPIC_RULES = {
    "Crypto": ["bitcoin", "btc", "eth", "crypto", "blockchain", "wallet", "coin", "nft"],
    "AI & Tech": [
        "ai", "gpt", "python", "code", "tech", "tesla", "robot", "apple", "google", "microsoft", "dev",
    ],
    "Gaming": ["game", "play", "steam", "xbox", "ps5", "nintendo", "twitch"],
    "Politics": ["president", "vote", "election", "war", "law", "gov", "policy", "news"],
    "Movies & TV": ["movie", "film", "cinema", "watch", "actor", "netflix", "series"],
}
OTHER_TOPIC = "Other"

# Substrings that make an encyclopedia edit relevant.
WATCH_LIST = [
    "python", "java", "code", "software", "bug",
    "ai", "gpt", "intelligence", "robot",
    "crypto", "bitcoin", "ethereum", "blockchain", "nft",
    "google", "microsoft", "apple", "tesla", "amazon",
    "game", "playstation", "xbox", "nintendo", "steam",
    "movie", "film", "series", "netflix",
    "politics", "election", "president", "war", "law",
    "economy", "market", "money", "stock",
    "sport", "football", "soccer", "nba",
]

# Search expression of the tweet feed: any of these words, in this language, page of 20.
SEARCH_WORDS = ["bitcoin", "ai", "python"]
SEARCH_LANGUAGE = "en"
SEARCH_PAGE = 20

# Names stamped on messages and dimension rows.
SOURCE_TWEETS_CSV = "Twitter (Bitcoin Dataset)"
SOURCE_WIKI = "Wikipedia (Filtered)"
SOURCE_TWEETS_LIVE = "Twitter (Real)"
UNKNOWN_SOURCE = "unknown"
SOURCE_TYPE = "Social Network"
WIKI_SERVER = "en.wikipedia.org"

# Sentiment classes in the order of the model's predictions 0, 1, 2.
CLASSES = ["negative", "positive", "neutral"]
# Training labels in the same order; every other label counts as the third class.
LABELS = ["Negative", "Positive", "Neutral"]
IGNORED_LABEL = "Irrelevant"

# Shortest text taken from the tweets file, and its positional fields (0-based).
MIN_TEXT_LENGTH = 10
TWEET_FIELDS, TWEET_DATE_FIELD, TWEET_TEXT_FIELD = 10, 8, 9

# Model settings.
HASH_BUCKETS = 20_000
MAX_ITERATIONS = 20
REGULARISATION = 0.01
TRAIN_SHARE, SPLIT_SEED = 0.8, 42

# Report sizes.
LOAD_LIMIT = 2_000_000
ADHOC_LIMIT = 1_000
FILTER_VALUES_LIMIT = 100
TOP_TOPICS, TOP_NEGATIVE, NEGATIVE_EXAMPLES = 10, 5, 10
HASHTAG_WEIGHT = 3
SAMPLE_ONE_IN = 100
# --- End of fixed values ----------------------------------------------------
