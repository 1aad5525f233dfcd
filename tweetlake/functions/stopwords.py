"""Stop-word lists used by token normalisation (P20).

The reference's own list is not shipped; it is described only as a long English list of the
SMART kind.  This is a parameter: callers may pass their own list.
"""

# English function words, alphabetical.  The queries on whole dictionaries leave out
# no others.
FUNCTION_WORDS = [
    "about", "above", "after", "again", "against", "all", "also", "am", "an", "and", "any", "are",
    "as", "at", "be", "because", "been", "before", "being", "below", "between", "both", "but", "by",
    "can", "could", "did", "do", "does", "doing", "down", "during", "each", "even", "ever", "every",
    "everyone", "few", "for", "from", "further", "get", "got", "had", "has", "have", "having", "he",
    "her", "here", "hers", "herself", "him", "himself", "his", "how", "if", "in", "into", "is",
    "it", "its", "itself", "just", "know", "lately", "let", "me", "more", "most", "much", "must",
    "my", "myself", "no", "nor", "not", "now", "of", "off", "on", "once", "only", "or", "other",
    "our", "ours", "ourselves", "out", "over", "own", "same", "she", "should", "so", "some",
    "still", "sub", "such", "than", "that", "the", "their", "theirs", "them", "themselves", "then",
    "there", "these", "they", "this", "those", "through", "to", "too", "under", "until", "up",
    "very", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom", "why",
    "will", "with", "would", "yet", "you", "your", "yours", "yourself", "yourselves",
]

# The longer list, alphabetical: the reference's rows leave these words out too.
STOP_WORDS = sorted(FUNCTION_WORDS + [
    "already", "always", "another", "anyone", "anything", "anyway", "around", "away", "believe",
    "best", "co", "come", "course", "done", "else", "everything", "far", "first", "go", "hardly",
    "help", "hi", "knows", "like", "looking", "ltd", "many", "mean", "might", "need", "needs",
    "never", "new", "nothing", "oh", "one", "re", "really", "right", "say", "see", "seems",
    "someone", "sorry", "sup", "thanks", "think", "try", "trying", "two", "using", "want", "way",
    "welcome", "without", "wonder",
])
