import pytest

from tablexport.llm import pii


@pytest.mark.parametrize("kind, source", [
    ("email", "john [at] example dot com"), ("email", "john at example [dot] com"), ("email", "john at example.com"), ("email", "john@example dot com"),
    ("email", "ann at uni dot pl"), ("email", "ann at uni dot se"), ("email", "ann at uni dot mx"), ("email", "ann at uni dot xyz"),
    ("email", "john dot doe at example dot com"), ("email", "j.doe7 at lab dot university"), ("email", "john(dot)doe at mail dot example (dot) org"),
    ("card", "4111 1111 one one one one 1111"), ("card", "four one one one 1111-1111-1111"),
    ("ip", "one nine two dot one six eight dot zero dot one"), ("ip", "192.168.zero.one"), ("ip", "192 dot 168 dot zero [dot] one"),
    ("phone", "+1 (five five five) 123 4567"), ("phone", "plus one 555 one two three 4567"),
])
def test_mixed_disguises_map_back_to_the_source(kind, source):
    for text in (source, f"write: {source}, now", f"é {source}"):
        base = pii.detect(text)
        assert (kind, source) in [(pii.KINDS[k], text[s:e]) for s, k, e in pii.disguised(text, base)], text


@pytest.mark.parametrize("text", ["we met at the dot of noon", "read more at example.com", "look at the polka dot dress", "he arrived at school.Then it rained",
                                  "page 12 one 34 and two", "4111 1111 one one one one 1112", "one nine nine nine dot one dot two dot three", "version 1.2 one", "stop at a dot is fun"])
def test_prose_stays_clean(text):
    assert pii.scan(text)[5] == ""


def test_base_spans_win_and_long_runs_take_one_pass():
    assert pii.scan("bob@example.com dot your i")[5] == "email:0:15"
    pii.scan("a at " * 40_000 + "x dot " * 40_000 + "one " * 40_000 + "1 " * 40_000 + "a@" * 40_000)
