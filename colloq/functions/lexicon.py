"""Patterns of the language signals, and stop words."""

# Patterns by category, in this order.
LEXICON = {
    "hedge": [
        r"\bi think\b", r"\bi guess\b", r"\bi suppose\b", r"\bi assume\b", r"\bi believe\b",
        r"\bprobably\b", r"\bmaybe\b", r"\bperhaps\b", r"\bpossibly\b", r"\bkind of\b",
        r"\bkinda\b", r"\bsort of\b", r"\bsorta\b",
        r"\b(?:i'?m )?not (?:really |entirely |totally |100% )?sure\b",
        r"\bi (?:don'?t|do not) know\b", r"\bi dunno\b", r"\bmight\b", r"\bi feel like\b",
        r"\bi'?d say\b", r"\bseems?\b", r"\bsomewhat\b",
    ],
    "filler": [r"\bu+m+\b", r"\bu+h+\b", r"\berm+\b", r"\ber\b", r"\bhm+\b", r"\bah+\b", r"\byou know\b"],
    "repair": [
        r"\b(\w+)[\s,]+\1\b", r"\b\w+-(?=\s|$)", r"\w\s?(?:—|--)\s?",
        r"\bi mean\b", r"\bor rather\b", r"\bno,? wait\b", r"\bsorry,", r"\bwhat i mean(?:t)? is\b",
        r"\blet me (?:rephrase|start again|think)\b", r"\bactually,? no\b",
    ],
    "pause_marker": [
        r"\.\.\.", "…",
        r"[\[(](?:pause|silence|long pause|\d+(?:\.\d+)?\s*s(?:ec(?:onds?)?)?)[\])]",
    ],
    "constraint": [
        r"\b(?:forced|forces|wouldn'?t let|won'?t let|doesn'?t let|didn'?t let|does not let|"
        r"did not let|won'?t allow|doesn'?t allow|didn'?t allow)\s+(?:me|us)\b",
        r"\bi (?:had|have|needed|need) to\b", r"\bi (?:was|got|am|'m) stuck\b",
        r"\bi (?:couldn'?t|can'?t|could not|cannot)\b", r"\bno way to\b", r"\bit kept\b",
        r"\bgave up\b",
    ],
    "implicit_request": [
        r"\bis there (?:a|any) way\b", r"\bcan (?:it|you|i)\b(?=[^.!?]*\?)",
        r"\bcould (?:it|you|i)\b(?=[^.!?]*\?)", r"\bi wish\b",
        r"\b(?:it )?(?:would|'d) be (?:so |really )?(?:nice|great|good|helpful|handy|useful|easier)\b",
        r"\bwhy (?:can'?t|doesn'?t|won'?t|isn'?t)\b", r"\bif only\b",
    ],
    "workaround": [
        r"\bwork[- ]?arounds?\b", r"\bi ended up\b", r"\bwhat i do is\b",
        r"\bmy (?:solution|fix|hack) (?:is|was)\b", r"\bthe (?:only )?way i (?:got|get|managed)\b",
        r"\bi just use\b", r"\bmanually\b", r"\bspreadsheet\b",
    ],
    "switching": [
        r"\bswitch(?:ed|ing)? (?:to|from|over|back)\b", r"\bmov(?:ed|ing) (?:to|from|over|back)\b",
        r"\bwent back to\b", r"\b(?:cancell?ed|unsubscribed|uninstalled|churned)\b",
        r"\balternatives?\b", r"\breplacement for\b", r"\bgave up on\b",
    ],
}
HESITATION = ("hedge", "filler", "repair", "pause_marker")
#: Categories that any regular-expression engine without look-around and back-references can count.
PLAIN = ("hedge", "filler", "pause_marker", "constraint", "workaround", "switching")

ECHO_AGREE = (
    r"^\W*(?:this|same|same here|me too|\+1|exactly|agreed|agree|100%|yep|yes|seconded|so much this|"
    r"came here to say this|this right here|same issue|same problem|same experience|"
    r"i have the same|i had the same|happening to me too|same for me)\b"
)
ECHO_DISAGREE = (
    r"^\W*(?:no|nah|nope|disagree|i disagree|hard disagree|not really|not true|wrong|"
    r"that's not|that isn't|not my experience)\b"
)
ECHO_MAX_WORDS = 15
PROMO = (
    r"(use (?:my )?code|discount code|affiliate|dm me|check out my|sign up (?:here|at)|"
    r"link in (?:my )?bio|promo|sponsored|referral)"
)

# Words added to the English stop words.
EXTRA_STOP = (
    "yeah", "okay", "ok", "like", "just", "really", "um", "uh", "gonna", "wanna", "lot", "pretty",
    "actually", "honestly", "thing", "things", "stuff", "don't", "didn't", "doesn't", "i'm", "it's",
    "i've", "that's", "there's", "can't", "won't", "isn't", "wasn't", "i'd", "you're", "they're",
    "we're", "i'll", "let's", "user", "u", "got", "get", "going", "know", "think", "say", "said",
    "want", "way", "use", "used", "using", "make", "does", "did", "doing", "also", "still", "even",
)


def stop_words() -> list[str]:
    """Spark ML's English stop words and the additions, sorted."""

    return sorted({w.lower() for w in _english()} | set(EXTRA_STOP))


def _english() -> list[str]:
    """Spark's English list: from the session, or where none runs (the SQL is asked for first) from its jar."""
    import zipfile
    from pathlib import Path

    import pyspark

    if pyspark.SparkContext._active_spark_context is not None:
        from pyspark.ml.feature import StopWordsRemover

        return StopWordsRemover.loadDefaultStopWords("english")
    jar = next((Path(pyspark.__file__).parent / "jars").glob("spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as z:
        return z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split()
