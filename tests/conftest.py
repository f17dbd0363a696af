import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidemark-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The five sample posts, with published totals.
SAMPLE_POSTS = [
    {
        "id": "1850000000000000001", "created_at": "2026-01-15T14:02:00.000Z",
        "text": "This is an amazing milestone for the team. Huge win and I am so excited!",
        "source": "Twitter for iPhone",
        "public_metrics": {"like_count": 48210, "retweet_count": 5120, "reply_count": 3120, "quote_count": 410},
    },
    {
        "id": "1850000000000000002", "created_at": "2026-01-15T09:30:00.000Z",
        "text": "The launch was delayed again. This is a problem and pretty disappointing.",
        "source": "Twitter Web App",
        "public_metrics": {"like_count": 12010, "retweet_count": 980, "reply_count": 2200, "quote_count": 145},
    },
    {
        "id": "1850000000000000003", "created_at": "2026-01-15T18:45:00.000Z",
        "text": "Shipping the update tonight. Status report to follow.",
        "source": "Twitter for iPhone",
        "public_metrics": {"like_count": 8800, "retweet_count": 410, "reply_count": 600, "quote_count": 33},
    },
    {
        "id": "1850000000000000004", "created_at": "2026-01-16T11:15:00.000Z",
        "text": "Incredible progress today. The best engineers in the world made this happen.",
        "source": "Twitter for Android",
        "public_metrics": {"like_count": 61500, "retweet_count": 7300, "reply_count": 2900, "quote_count": 690},
    },
    {
        "id": "1850000000000000005", "created_at": "2026-01-16T16:20:00.000Z",
        "text": "Some servers went down. Working on a fix now.",
        "source": "Twitter Web App",
        "public_metrics": {"like_count": 5400, "retweet_count": 320, "reply_count": 1500, "quote_count": 88},
    },
]


@pytest.fixture(scope="session")
def sample_dir(tmp_path_factory):
    """The sample posts as an array file, as lines, and as a saved search response."""
    root = tmp_path_factory.mktemp("posts")
    for name in ("json", "jsonl", "search"):
        (root / name).mkdir()
    (root / "json" / "a.json").write_text(json.dumps(SAMPLE_POSTS))
    (root / "jsonl" / "a.jsonl").write_text("\n".join(json.dumps(p) for p in SAMPLE_POSTS) + "\n\n")
    (root / "search" / "a.json").write_text(json.dumps({"data": SAMPLE_POSTS, "meta": {"result_count": 5}}))
    (root / "search" / "empty.json").write_text(json.dumps({"meta": {"result_count": 0}}))
    return str(root)


@pytest.fixture(scope="session")
def sample(spark, sample_dir):
    from tidemark.sources import read_posts

    return read_posts(spark, f"{sample_dir}/jsonl").drop("quality_flags")
