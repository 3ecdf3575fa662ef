"""Prompt template banks (our own wording).

Open questions, and topic templates whose ``{topic}`` slot receives the
topic.  Index choice is ``floor(u * len(bank))`` so the banks' order is part of the
result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOPIC_SLOT = "{topic}"

OPEN_QUESTIONS = [
    "What have you been up to lately?",
    "How has life been treating you recently?",
    "Anything new since we last talked?",
    "Tell me about something that happened to you this week.",
    "What is on your mind today?",
    "Any news you would like to share?",
    "What kept you busy over the last few days?",
    "Has anything surprised you lately?",
    "What was the highlight of your week?",
    "Is there something you have been thinking about a lot?",
    "What did you learn recently?",
    "How are things going at the moment?",
    "What made you smile recently?",
    "Share a thought you had today.",
    "What is the latest with you?",
    "Anything interesting happen to you recently?",
    "What are you working on these days?",
    "Have you tried anything new lately?",
    "What is something you noticed today?",
    "Tell me what you have been reading or watching.",
    "What would you like to tell people right now?",
    "Any plans you are excited about?",
    "What has been challenging for you lately?",
    "Is there a story from this month you can tell?",
    "What did you do over the weekend?",
    "What is one thing you want to remember from this week?",
    "How would you sum up your day?",
    "What caught your attention recently?",
    "Anything you want to get off your chest?",
    "What have you discovered lately?",
    "Where did your day take you?",
    "Who did you talk to this week, and what about?",
    "What would you do differently if today began again?",
    "Name one small thing that went well.",
    "What are you looking forward to?",
    "Which habit are you trying to keep up?",
    "What did you change your mind about?",
    "How did the morning go?",
    "What is playing while you write this?",
    "Is anything making you impatient right now?",
    "Which question have you been asked too often?",
    "What did you cook, fix or build most recently?",
    "Describe the view from where you are.",
    "What would your friends say you talk about too much?",
    "If you had one more free hour today, where would it go?",
]

TOPIC_TEMPLATES = [
    "Say a few words about {topic}.",
    "{topic} came up in conversation. What would you add?",
    "Write a short note that mentions {topic}.",
    "Suppose a friend asks you about {topic}. What do you answer?",
    "Where does {topic} show up in your week?",
    "Sum up {topic} in one post.",
    "Post an update on {topic}.",
    "If {topic} were today's subject, how would you begin?",
    "Give me your honest view on {topic}.",
    "Remind me why {topic} is worth a post.",
    "When did you last deal with {topic}?",
    "Somebody new wants to understand {topic}. Help them out.",
    "Start a thread on {topic}.",
    "Which side of {topic} do people overlook?",
    "Let's talk {topic}. You go first.",
    "Keep it brief: {topic}.",
    "Describe {topic} the way you would to a neighbour.",
    "Pick {topic} as your theme and write.",
    "What would you change about {topic}?",
    "Tell us where you stand on {topic}.",
    "One thought on {topic}, please.",
    "What do newcomers get wrong about {topic}?",
    "Compare {topic} now with how it was a year ago.",
    "Is {topic} overrated or underrated?",
    "Tell the short version of your history with {topic}.",
    "Ask a question about {topic}, then answer it.",
    "Who should hear more about {topic}, and why?",
    "Make a case against {topic}.",
    "What does {topic} remind you of?",
    "Write the post about {topic} that you would like to read.",
    "Explain {topic} without using its name twice.",
    "What is the next thing to happen with {topic}?",
    "Leave a reply under a post on {topic}.",
]


def bank_column(bank: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in bank])


def pick(bank: list[str], idx: Column) -> Column:
    """0-based pick from a literal bank (NULL when out of range)."""
    return F.get(bank_column(bank), idx)


def sql_list(bank: list[str]) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in bank) + "]"
