"""Hand-written match documents and helper dimensions (FIXTURES.md §2)."""

import os

DOC_1001 = """info:
  city: Leeds
  dates: [2020-07-01, 2020-07-02]
  match_type: ODM
  gender: male
  umpires: [U One, U Two]
  venue: Ground A
  teams: [Reds, Blues]
  toss: {winner: Reds, decision: bat}
  outcome: {winner: Blues, by: {wickets: 7}}
  player_of_match: [A Ann]
  registry: {people: {A Ann: p1, B Bob: p2, C Cat: p3, D Dan: p4}}
innings:
- 1st innings:
    team: Reds
    deliveries:
    - 0.1: {batsman: A Ann, bowler: D Dan, non_striker: B Bob, runs: {batsman: 4, extras: 0, total: 4}}
    - 0.2: {batsman: A Ann, bowler: D Dan, non_striker: B Bob, runs: {batsman: 0, extras: 0, total: 0}, wicket: {kind: bowled, player_out: A Ann}}
    - 0.10: {batsman: C Cat, bowler: D Dan, non_striker: B Bob, runs: {batsman: 6, extras: 1, total: 7}}
- 2nd innings:
    team: Blues
    deliveries:
    - 0.1: {batsman: D Dan, bowler: A Ann, non_striker: E Eve, runs: {total: 1, extras: 1}, declared: yes}
"""

DOC_1002 = """info:
  dates: ['2021-01-05']
  umpires: [Solo Ump]
  teams: [Reds]
  outcome: {result: no result, by: {innings: 1, runs: 50}}
innings: []
"""

DOC_1003 = "info: {teams: [A"

DOC_1004 = """info: {teams: [X, Y], dates: []}
innings:
- 1st innings: {team: X, deliveries: [{0.1: {batsman: a, runs: {total: 1}}}, {0.2: {batsman: a}}]}
"""

EVENTS = {"1001": '{"info":{"event":{"name":"World Cup"}}}', "1002": '{"info":{}}', "1003": "{bad"}

PEOPLE_CSV = """identifier,key_cricinfo,name,unique_name
p1,11,Ann,A Ann
p2,,Bob,B Bob
p3,13,Cat,C Cat (2)
p4,14,Dan,D Dan
"""
CRICINFO_CSV = """ID,NAME,BATTING STYLE,BOWLING STYLE
11,Annabel Ann,Right-hand bat,Right-arm
"""
LEAGUES_CSV = """team_name,league
Reds,Club
Blues,Men International
"""

DOCS = {"1001": DOC_1001, "1002": DOC_1002, "1003": DOC_1003, "1004": DOC_1004}


def write_docs(folder, ids=("1001", "1002", "1003", "1004"), events=True):
    os.makedirs(folder, exist_ok=True)
    for i in ids:
        with open(os.path.join(folder, f"{i}.yaml"), "w") as f:
            f.write(DOCS[i])
        if events and i in EVENTS:
            with open(os.path.join(folder, f"{i}.json"), "w") as f:
                f.write(EVENTS[i])
    return folder


def write_helpers(folder):
    os.makedirs(folder, exist_ok=True)
    paths = {}
    for name, text in (("people", PEOPLE_CSV), ("cricinfo", CRICINFO_CSV), ("leagues", LEAGUES_CSV)):
        p = os.path.join(folder, f"{name}.csv")
        with open(p, "w") as f:
            f.write(text)
        paths[name] = p
    return paths
