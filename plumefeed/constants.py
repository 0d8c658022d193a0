"""Values fixed by the feature-record format and the scoring rules.

These must stay exactly as they are: producers, stored ids and published scores
depend on them.
"""

# Positional order of the tab-separated feature record.
FEATURE_COLUMNS = [
    "text_tokens",
    "hashtags",
    "tweet_id",
    "present_media",
    "present_links",
    "present_domains",
    "tweet_type",
    "language",
    "tweet_timestamp",
    "engaged_with_user_id",
    "engaged_with_user_follower_count",
    "engaged_with_user_following_count",
    "engaged_with_user_is_verified",
    "engaged_with_user_account_creation",
    "engaging_user_id",
    "engaging_user_follower_count",
    "engaging_user_following_count",
    "engaging_user_is_verified",
    "engaging_user_account_creation",
    "engagee_follows_engager",
]
POSITION = {name: i for i, name in enumerate(FEATURE_COLUMNS)}

FIELD_SEP = "\t"
LIST_SEP = "\x01"

# Tokens that never reach decoded text.
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]

# Constants the CSV adapter writes.
UNKNOWN_LANGUAGE = "und"
UNKNOWN_AUTHOR = "unknown"
READER_ID = "sample-reader"
FALLBACK_ID_PREFIX = "brightdata-row-"

# Namespace of the version-5 UUIDs used as point ids (RFC 9562, URL namespace).
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"

# Characters str.strip() removes in Python, i.e. Unicode white space.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Characters java.lang.String.trim() removes: everything up to U+0020.
JAVA_WHITESPACE = "".join(chr(c) for c in range(0x21))
