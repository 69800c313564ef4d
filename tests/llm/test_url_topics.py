"""Clean urls that name a topic pass; the vocabulary holds no host of the test pages."""

from arrivo.llm import urls

CLEAN = ["https://city.example/adult-education", "https://w.example/phishing-awareness", "https://lab.example/malware-analysis",
         "https://w.example/escort/mission", "https://w.example/police-escorts", "https://w.example/young-adult/books"]
BAD = ["https://w.example/adult-webcams", "https://w.example/escort?sexy=1", "https://w.example/malware-keygen",
       "https://free-phishing.example/", "https://spam-farm.example/", "https://cheap-pills.example/"]


def test_topic_words_alone_pass():
    automaton = urls._automaton(urls.STRICT, urls.SOFT)
    assert [u for u in CLEAN if urls._rejected(automaton, u, 2)] == []
    assert [u for u in BAD if not urls._rejected(automaton, u, 2)] == []


def test_vocabulary_holds_single_words():
    assert all(t.isalpha() for t in urls.STRICT + urls.SOFT)
    assert not set(urls.STRICT) & set(urls.SOFT)
