"""Expressions over ``messages: array<struct<role, content>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.config import ROLES, SYSTEM_PROMPT, ChatTemplate
from stratalog.functions.text import is_blank

MESSAGES = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def last(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))


def has_role(messages: Column, role: str) -> Column:
    return F.exists(messages, lambda m: m.role.eqNullSafe(F.lit(role)))


def contents(messages: Column, role: str) -> Column:
    return F.transform(F.filter(messages, lambda m: m.role == role), lambda m: m.content)


def turn_error(role: Column, content: Column) -> Column:
    """What is wrong with one message, or null."""
    return F.when(
        ~F.coalesce(role.isin(*ROLES), F.lit(False)),
        F.concat(F.lit("unknown role: "), F.coalesce(role, F.lit("none"))),
    ).when(is_blank(content), F.concat(F.lit("blank content in role "), role))


def example_error(messages: Column) -> Column:
    """First error of a chat example in checking order, or null for a valid one."""
    per_turn = F.filter(
        F.transform(messages, lambda m: turn_error(m.role, m.content)), lambda e: e.isNotNull()
    )
    return (
        F.when(messages.isNull(), F.lit("messages missing or not a list"))
        .when(
            ~has_role(messages, "user") | ~has_role(messages, "assistant"),
            F.lit("no user or assistant message"),
        )
        .when(F.size(per_turn) > 0, F.try_element_at(per_turn, F.lit(1)))
        .when(last(messages).role != "assistant", F.lit("last message is not from assistant"))
    )


def content_key(messages: Column) -> Column:
    """sha256 over the user and assistant texts; system messages do not count."""
    return F.sha2(
        F.concat(
            F.array_join(contents(messages, "user"), "||"),
            F.lit("###"),
            F.array_join(contents(messages, "assistant"), "||"),
        ),
        256,
    )


def has_system(messages: Column, prompt: str = SYSTEM_PROMPT) -> Column:
    return F.exists(
        messages,
        lambda m: m.role.eqNullSafe(F.lit("system")) & m.content.eqNullSafe(F.lit(prompt)),
    )


def with_system(messages: Column, prompt: str = SYSTEM_PROMPT) -> Column:
    """Exactly one system message, in front."""
    return F.concat(
        F.array(message("system", F.lit(prompt))),
        F.filter(messages, lambda m: m.role != "system"),
    )


def render_turn(role: Column, content: Column, template: ChatTemplate) -> Column:
    return F.concat(
        F.lit(template.before_role),
        role,
        F.lit(template.after_role),
        content,
        F.lit(template.after_content),
    )


def render(
    messages: Column, template: ChatTemplate = ChatTemplate(), generation: bool = False
) -> Column:
    text = F.array_join(
        F.transform(messages, lambda m: render_turn(m.role, m.content, template)), ""
    )
    return F.concat(text, F.lit(template.generation)) if generation else text


def prompt_messages(messages: Column) -> Column:
    """All messages before the last."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))
