"""Fixed values that results depend on.

These must equal the values of the source pipeline for the same results; they
are stated here plainly, in their natural order.
"""

# --- fixed values -----------------------------------------------------------

# Team code -> team name (names keep '-' for spaces; some are lower case).
TEAM_CODES = [
    (40, "Afghanistan"),
    (2, "Australia"),
    (25, "Bangladesh"),
    (1, "England"),
    (6, "India"),
    (29, "Ireland"),
    (5, "New-Zealand"),
    (7, "Pakistan"),
    (3, "South-Africa"),
    (8, "Sri-Lanka"),
    (4, "West-Indies"),
    (9, "Zimbabwe"),
    (15, "Netherlands"),
    (26, "kenya"),
    (27, "united-arab-emirates"),
    (30, "scotland"),
    (17, "canada"),
    (12, "bermuda"),
    (335974, "chennai-super-kings"),
    (335970, "royal-challengers-bangalore"),
    (335975, "delhi-capitals"),
    (335978, "mumbai-indians"),
    (968721, "rising-pune-supergiants"),
    (628333, "sunrisers-hyderabad"),
    (335973, "punjab-kings"),
    (335971, "kolkata-knight-riders"),
    (335977, "rajasthan-royals"),
    (474668, "kochi-tuskers-kerala"),
    (474666, "pune-warriors"),
    (968725, "gujarat-lions"),
    (28, "namibia"),
]

# Season text -> season year.
SEASON_RECODE = {
    "2006-07-01": "2006",
    "2019": "2019",
    "2010-11-01": "2011",
    "2023/24": "2023",
    "2014/15": "2015",
    "2002-03-01": "2003",
    "2021": "2021",
    "2007-08-01": "2007",
    "2009-10-01": "2009",
    "1987/88": "1987",
    "1995/96": "1995",
    "1991/92": "1991",
    "2020/21": "2020",
}

# Series name -> list of new names; the first entry is used.
SERIES_RECODE = {
    "ICC CRICKET WORLD CUP": ["ICC WORLD CUP"],
    "PEPSI INDIAN PREMIER LEAGUE": ["INDIAN PREMIER LEAGUE"],
}

# Dismissals that name no bowler.
NO_BOWLER_DISMISSALS = ["not out", "runout", "timed out", "absent hurt", "retired hurt", "absent"]

# Characters removed from names found in dismissal text.
DISMISSAL_BAD_CHARS = [";", ":", "!", "*", "†", "‚", "'"]

# Rows a complete match summary has (one per player of both sides).
PLAYERS_PER_MATCH = 22

# Player dimension defaults.
DEFAULT_DOB = "1975-01-01"
DEFAULT_BATTING_STYLE = "RIGHT-HAND BAT"
DEFAULT_BOWLING_STYLE = "RIGHT-ARM OFFBREAK"

# Default month of a match date with no month.
DEFAULT_MONTH = "JANUARY"

# Columns of the bronze files: their names and order are part of the result.
TEAM_SHEET_COLUMNS = ["player_name", "player_id", "captain_flag"]
BATTING_COLUMNS = ["player_name", "dismissal", "runs_scored", "balls_faced", "minutes_send",
                   "fours_count", "six_count", "strike_rate"]
BOWLING_COLUMNS = ["player_name", "overs_bowled", "maiden_over", "runs_given", "wickets_taken",
                   "economy", "dots_ball_bowled", "fours_scored_by_batter",
                   "six_scored_by_batter", "wide_ball", "no_balls"]
MASTER_COLUMNS = ["player_id", "player_first_name", "player_last_name", "player_DOB",
                  "country_representative", "batting_style", "bowling_style"]

# Silver match summary: each column and what it holds.  The names and their order are
# part of the result.  int and double are cast safely and filled with 0, upper is
# upper-case text, text is left as it is.
MATCH_SUMMARY_SCHEMA = [
    ("match_id", "int"), ("match_type", "upper"), ("series_name", "upper"), ("season", "upper"),
    ("team_1", "upper"), ("team_2", "upper"), ("toss_own_by", "upper"), ("toss_choice", "upper"),
    ("own_team", "upper"), ("match_day", "int"), ("match_month", "upper"), ("match_year", "int"),
    ("player_of_the_match_player_name", "upper"), ("player_of_the_match_player_id", "int"),
    ("venue_id", "int"), ("venue_location", "upper"), ("stadium", "upper"), ("player_id", "int"),
    ("player_name", "upper"), ("player_DOB", "text"), ("country_representative", "upper"),
    ("country_representative_code", "int"), ("captain_flag", "upper"), ("batting_style", "upper"),
    ("runs_scored", "int"), ("balls_faced", "int"), ("minutes_send", "int"),
    ("fours_count", "int"), ("six_count", "int"), ("strike_rate", "double"),
    ("dismissal", "upper"), ("dismissal_bowler_id", "int"), ("outed_bowler_style", "upper"),
    ("catch_taken", "int"), ("bowling_style", "upper"), ("overs_bowled", "double"),
    ("maiden_over", "int"), ("runs_given", "int"), ("wickets_taken", "int"),
    ("economy", "double"), ("dots_ball_bowled", "int"), ("fours_scored_by_batter", "int"),
    ("six_scored_by_batter", "int"), ("wide_ball", "int"), ("no_balls", "int"),
]

# --- end of fixed values ----------------------------------------------------

MATCH_SUMMARY_COLUMNS = [name for name, _ in MATCH_SUMMARY_SCHEMA]


def summary_columns(kind: str) -> list[str]:
    """The silver columns of a kind, in silver order."""
    return [name for name, k in MATCH_SUMMARY_SCHEMA if k == kind]
