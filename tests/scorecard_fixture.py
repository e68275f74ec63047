"""Hand-made scorecard CSV trees (values invented, shapes as the bronze files)."""

from __future__ import annotations

import os

SIDE_A = ["Virat Kohli", "Rohit Sharma", "Jasprit Bumrah", "Ravichandran Ashwin",
          "Ravindra Jadeja", "MS Dhoni", "Hardik Pandya", "Shikhar Dhawan", "KL Rahul",
          "Rishabh Pant", "Mohammed Shami"]
SIDE_B = ["Quinton de-Kock", "Morne Morkel", "Mitchell Starc", "Babar Azam", "Shaheen Afridi",
          "Fakhar Zaman", "Imam Haq", "Shadab Khan", "Hasan Ali", "Mohammad Rizwan", "Haris Rauf"]
PLAYERS = SIDE_A + SIDE_B
IDS = {name: i + 1 for i, name in enumerate(PLAYERS)}

# side B batting, dismissed by side A
BATTING_B = [
    ("†Quinton de-Kock", "c Kohli b Bumrah", "40", "30"),
    ("Morne Morkel", "c & b Bumrah", "2", "5"),
    ("Mitchell Starc", "b Ashwin", "11", "9"),
    ("Babar Azam (c)", "lbw b Jadeja", "77", "60"),
    ("Shaheen Afridi", "st †Dhoni b Jadeja", "0", "1"),
    ("Fakhar Zaman", "hit wicket b Shami", "-", "-"),
    ("Imam Haq", "run out (Kohli/Dhoni)", "13", "20"),
    ("Shadab Khan", "not out", "9", "4"),
    ("Hasan Ali", "c Pant b Shami", "1", "2"),
    ("Mohammad Rizwan", "retired hurt", "5", "3"),
    ("Haris Rauf", "c Rohit Sharma b Pandya", "4", "4"),
]
# side A batting (second innings file)
BATTING_A = [("Virat Kohli (c)", "c †de-Kock b Morne Morkel", "55", "41"),
             ("Rohit Sharma", "b Starc", "12", "10")] + \
            [(n, "not out", "0", "0") for n in SIDE_A[2:]]
BOWLING_A = [("Jasprit Bumrah", "4.3", "0", "20", "2"), ("Ravichandran Ashwin", "10", "1", "45", "1"),
             ("Ravindra Jadeja", "8", "0", "30", "2"), ("Mohammed Shami", "7.2", "0", "33", "2"),
             ("Hardik Pandya", "3", "0", "25", "1")]
BOWLING_B = [("Morne Morkel", "6", "0", "30", "1"), ("mitchell starc", "5.1", "0", "28", "1")]


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def write_master(root, extra=()):
    rows = [f"{IDS[n]},{n.split(' ')[0]},{' '.join(n.split(' ')[1:])},1990-01-0{1 + i % 9},"
            f"\"right-hand bat,right-arm fast\",6" for i, n in enumerate(SIDE_A)]
    rows += [f"{IDS[n]},{n.split(' ')[0]},{' '.join(n.split(' ')[1:])},,\"left-hand bat\",7"
             for n in SIDE_B]
    rows += list(extra)
    _write(f"{root}/players-details/batch1/players.csv", rows)


def write_match(root, slug, venue_file, points, toss="India, elected to bat first",
                number="1st ODI", date="15 January 1997", pom="virat-kohli-1",
                sheet_players=None, batting=True, bowling=True, series="ICC Cricket World Cup",
                season="2023/24"):
    md = f"{root}/match-details"
    players = PLAYERS if sheet_players is None else sheet_players
    sheet = ["PLAYER_NAME,PLAYER_ID,CAPTAIN_FLAG"] + [
        f"{n},{IDS[n]},{'Y' if n in ('Virat Kohli', 'Babar Azam') else 'N'}" for n in players]
    _write(f"{md}/team-details/{slug}/players.csv", sheet)
    _write(f"{md}/venue-details/{slug}/{venue_file}", [
        "TOSS,SERIES,SEASON,PLAYER_OF_THE_MATCH,MATCH_NUMBER,MATCH_DATE,POINTS",
        f"\"{toss}\",{series},{season},{pom or ''},{number},{date},\"{points}\""])
    if batting:
        hdr = "PLAYER_NAME,DISMISSAL,RUNS_SCORED,BALL_FACED,MINUTES_SEND,FOURS_SCORED,SIXES_SCORED,STRIKE_RATE"
        _write(f"{md}/batting-scorecard/{slug}/scorecard/batting1.csv",
               [hdr] + [f"{n},{d},{r},{b},10,1,0,{'-' if r == '-' else '50.5'}"
                        for n, d, r, b in BATTING_B if n.replace('†', '').replace(' (c)', '') in
                        [p for p in players] or True])
        _write(f"{md}/batting-scorecard/{slug}/scorecard/batting2.csv",
               [hdr] + [f"{n},{d},{r},{b},5,0,0,20.0" for n, d, r, b in BATTING_A])
    if bowling:
        hdr = "PLAYER_NAME,OVERS_BOWLED,MAIDEN_OVER,RUNS_GIVEN,WICKETS_TAKEN,ECONOMY,DOT_BALLS,FOURS_GIVEN,SIXES_GIVEN,WIDE_BALLS,NO_BALLS"
        _write(f"{md}/bowling-scorecard/{slug}/scorecard/bowling1.csv",
               [hdr] + [f"{n},{o},{m},{r},{w},5.5,10,2,1,0,-" for n, o, m, r, w in BOWLING_A])
        _write(f"{md}/bowling-scorecard/{slug}/scorecard/bowling2.csv",
               [hdr] + [f"{n},{o},{m},{r},{w},6.0,8,1,0,1,0" for n, o, m, r, w in BOWLING_B])


def build_tree(root):
    write_master(root, extra=[
        # a second, differing row for player 1: the dimension keeps one row per id
        "1,Virat,Kohli,1988-11-05,\"right-hand bat,right-arm medium\",6"])
    write_match(root, "india-vs-pakistan-1st-odi-1001", "wankhede-stadium-maharashtra-55.csv",
                "India won by 5 runs")
    write_match(root, "india-vs-pakistan-2nd-odi-1002", "eden-gardens-west-bengal-56.csv",
                "India 0, Pakistan 2", number="2nd T20I no. 7", date="1.5 March 2019",
                pom=None, season="2019")
    write_match(root, "new-zealand-vs-pakistan-3rd-odi-1003", "basin-reserve-wellington-57.csv",
                "New Zealand won by 2 wickets", sheet_players=PLAYERS[:21])
    write_match(root, "england-vs-ireland-4th-odi-1004", "lords-london-58.csv",
                "England won by 1 run", batting=False)
    write_match(root, "india-vs-pakistan-5th-odi-1005", "ground-x-59.csv", "no result")
