"""A chat-completions client that answers by a rule, for tests of the live path."""

from __future__ import annotations

import sys
from typing import Callable

from pyspark import cloudpickle

from quarry.functions.response import DEFAULT_MODEL, PROMPT_BODY
from quarry.operators.annotate import live

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # Python workers don't have the tests' folder


class _Msg:
    def __init__(self, content):
        self.content = content


class _Choice:
    def __init__(self, content):
        self.message = _Msg(content)


class _Resp:
    def __init__(self, content):
        self.choices = [_Choice(content)]


class _Completions:
    def __init__(self, answer: Callable[[str, str], str], fail_models: frozenset):
        self._answer, self._fail = answer, fail_models

    def create(self, model, messages, temperature=None, **_):
        if model in self._fail:
            raise RuntimeError(f"model {model} unavailable")
        user = messages[-1]["content"]
        marker = PROMPT_BODY.rsplit("\n\n", 1)[-1]
        text = user.split(marker, 1)[1] if marker in user else user
        return _Resp(self._answer(text, model))


class _Chat:
    def __init__(self, completions):
        self.completions = completions


def rule_answer(text: str, model: str = DEFAULT_MODEL) -> str:
    """A deterministic answer computed from the whole text.

    The shape is chosen by text length: 0 -> labelled lines with a Yes grade
    and details; 1 -> labelled summary and a No grade; 2 -> numbered lines
    with a Maybe grade.  The summary states the word and character counts,
    the details the first and last word.
    """
    words = text.split()
    summary = f"A text of {len(words)} words and {len(text)} characters."
    details = f"It starts with {words[0]} and ends with {words[-1]}." if words else "It is empty."
    k = len(text) % 3
    if k == 0:
        return f"Summary: {summary}\nRelevant: Yes\nDetails: {details}"
    if k == 1:
        return f"Summary: {summary}\nRelevance: no"
    return f"1. Summary: {summary}\n2. Relevant: Maybe\n3. {details}"


class OfflineClient:
    """A chat-completions client that answers locally with ``rule_answer``; ``fail_models`` makes chosen models raise."""

    def __init__(self, answer: Callable[[str, str], str] = rule_answer, fail_models=()):
        self.chat = _Chat(_Completions(answer, frozenset(fail_models)))


def offline_client_factory(fail_models=()) -> Callable[[], OfflineClient]:
    fail = tuple(fail_models)
    return lambda: OfflineClient(fail_models=fail)


def offline(fail_models=(), **kw):
    """An answerer on that client."""
    return live(offline_client_factory(fail_models), **kw)
