"""Hand-written capture files; all names and texts are invented."""

from __future__ import annotations

import json
from pathlib import Path

DAY = "2015-06-26T09:08:07.000Z"


def user(ident, **fields):
    base = {"id": ident, "name": ident, "username": ident, "created_at": DAY, "location": "Austin, TX",
            "description": "about me", "verified": False,
            "public_metrics": {"followers_count": 5, "following_count": 4, "listed_count": 0, "tweet_count": 9}}
    return {**base, **fields}


def tweet(ident, author, text, ref=None, order=("type", "id")):
    out = {"id": ident, "author_id": author, "created_at": DAY, "text": text}
    if ref:
        out["referenced_tweets"] = [{k: {"type": "retweeted", "id": ref}[k] for k in order}]
    return out


def payload(tweets, users=(), originals=(), errors=()):
    out = {"data": list(tweets), "includes": {"users": list(users), "tweets": list(originals)},
           "meta": {"result_count": len(tweets), "newest_id": "9", "oldest_id": "1"}}
    if errors:
        out["errors"] = list(errors)
    return out


def write(root, event, name, body):
    folder = Path(root) / event
    folder.mkdir(parents=True, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False, indent=2)
    (folder / name).write_text(text, encoding="utf-8")


def first_files(root):
    """Two readable files, one truncated file, one file with an unusable name, one non-JSON file."""
    write(root, "ss_marriage", "same_sex_marriage_2015-06-26_2015-06-27.json", payload(
        tweets=[
            tweet("1", "a", "RT @c: happy love wins", ref="90"),              # original included
            tweet("2", "b", "RT @d: gone post", ref="91"),                    # original lost
            tweet("3", "a", "agree with this", ref="92", order=("id", "type")),  # quote, other key order
            tweet("4", "c", "hope and hope and fear"),                        # no reference
            tweet("5", "zz", "author is unknown"),                            # author not delivered
        ],
        users=[user("a"), user("b", location=None, description="both ' and \""), user("c", location="Texas, USA")],
        originals=[{"id": "90", "text": "happy love wins today"}, {"id": "92", "text": "a quoted joy"},
                   {"id": "93", "text": "nobody refers to me"}],
        errors=[{"value": "91", "title": "Not Found Error", "resource_type": "tweet"}]))
    write(root, "ebola", "africa_2014-03-23_2014-03-24.json", payload(
        tweets=[tweet("6", "a", "fear spreads"), tweet("4", "c", "hope and hope and fear")],  # 4 again, other search
        users=[user("a"), {"id": "e", "name": "e", "username": "e"}],        # a again; e bare
        originals=[]))
    write(root, "ebola", "cut_2014-03-23_2014-03-24.json", '{"data": [\n{"id": "7", "text": "no en')
    write(root, "ebola", "notes.json", payload([tweet("8", "a", "unnamed file")], [user("a")]))
    write(root, "ebola", "readme.txt", "not a payload")


LEXICON = [("love", "joy", 1), ("love", "positive", 1), ("happy", "joy", 1), ("hope", "anticipation", 1),
           ("fear", "fear", 1), ("fear", "negative", 1), ("joy", "joy", 1), ("agree", "trust", 0)]
