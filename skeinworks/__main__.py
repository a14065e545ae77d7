"""Command line: ``python -m skeinworks --data FOLDER VERB ...``, rows as text or JSON."""

from __future__ import annotations

import argparse
import json
import sys

from skeinworks.curriculum import Curriculum
from skeinworks.session import local_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skeinworks")
    parser.add_argument("--data", required=True)
    parser.add_argument("--json", action="store_true")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb, arguments in {
        "search": ["query"], "kp": ["name"], "chain": ["kp_id"], "learned": ["lesson_id"], "archetypes": ["kp_id"],
        "contexts": ["text"], "glossary": ["text"], "boundary": ["lesson_id"], "instantiate": ["card_id"],
    }.items():
        p = verbs.add_parser(verb)
        for a in arguments:
            p.add_argument(a)
        p.add_argument("-k", type=int, default=10)
        p.add_argument("--grade", type=int)
        p.add_argument("--seed", type=int, default=0)
        p.add_argument("--direction", default="prerequisite")
    a = parser.parse_args(argv)
    cur = Curriculum.load(local_session(2), a.data)
    rows = {
        "search": lambda: cur.search(a.query, a.k, grade=a.grade),
        "kp": lambda: cur.find_kp(a.name),
        "chain": lambda: cur.chain(a.kp_id, a.direction),
        "learned": lambda: cur.learned_before(a.lesson_id, grade=a.grade).select("kp_id", "name"),
        "archetypes": lambda: cur.archetypes(a.kp_id).select("id", "item_form", "difficulty"),
        "contexts": lambda: cur.contexts(a.grade, a.text),
        "glossary": lambda: cur.glossary_search(a.text),
        "boundary": lambda: cur.boundary(a.lesson_id),
        "instantiate": lambda: cur.instantiate_many(a.card_id, a.k, a.seed),
    }[a.verb]()
    for r in rows.toLocalIterator():
        d = r.asDict(recursive=True)
        print(json.dumps(d, ensure_ascii=False, default=str) if a.json else "\t".join("" if v is None else str(v) for v in d.values()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
