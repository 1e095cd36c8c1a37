"""Fixed schemas and the constants that define results."""

from __future__ import annotations

# The columns of the tables.
GAMES = "game_id string, game_date string, season string, season_type string, home_team_id string, away_team_id string, home_team_abbr string, away_team_abbr string, home_pts string, away_pts string, home_win string"
OFFICIALS = "game_id string, official_id string, official_name string, jersey_num string"
PLAYER_LOGS = "game_id string, player_id string, player_name string, team_id string, team_abbr string, min string, pts string, reb string, ast string, stl string, blk string, tov string, fga string, fgm string, fg3a string, fg3m string, fta string, ftm string, pf string, plus_minus string"
ROUND_LABELS = "game_id string, round int, game_num int, source string"
OVERRIDES = "raw_name_or_id string, canonical_ref_key string, canonical_display_name string"

STATS = ("pts", "fta", "pf", "reb", "ast")
ZERO_FILLED = ("min", *STATS)

SEASON_FLOOR = 2000
CURRENT_SEASON = "2025-26"
OVERTIME_MINUTES = 505
SWING_MIN_GAMES, SWING_TOP = 15, 50
PLAYOFF_BASELINE_GAMES = 5
TOP_PERFORMANCES, PLAYER_TOP_GAMES = 25, 10
RATE_MIN_GAMES, TEAM_REF_MIN_GAMES = 200, 10
BOARD_SIZE, PARTNERS = 25, 5
LATEST_SEASON_GAMES = 1100

# The team codes, their names and other spellings.
CURRENT_TEAMS = {
    "ATL": "Atlanta Hawks", "BOS": "Boston Celtics", "BKN": "Brooklyn Nets", "CHA": "Charlotte Hornets", "CHI": "Chicago Bulls",
    "CLE": "Cleveland Cavaliers", "DAL": "Dallas Mavericks", "DEN": "Denver Nuggets", "DET": "Detroit Pistons", "GSW": "Golden State Warriors",
    "HOU": "Houston Rockets", "IND": "Indiana Pacers", "LAC": "LA Clippers", "LAL": "Los Angeles Lakers", "MEM": "Memphis Grizzlies",
    "MIA": "Miami Heat", "MIL": "Milwaukee Bucks", "MIN": "Minnesota Timberwolves", "NOP": "New Orleans Pelicans", "NYK": "New York Knicks",
    "OKC": "Oklahoma City Thunder", "ORL": "Orlando Magic", "PHI": "Philadelphia 76ers", "PHX": "Phoenix Suns", "POR": "Portland Trail Blazers",
    "SAC": "Sacramento Kings", "SAS": "San Antonio Spurs", "TOR": "Toronto Raptors", "UTA": "Utah Jazz", "WAS": "Washington Wizards",
}
HISTORICAL_TEAMS = {
    "SEA": "Seattle SuperSonics", "VAN": "Vancouver Grizzlies", "NJN": "New Jersey Nets", "CHH": "Charlotte Hornets (1988-2002)",
    "NOH": "New Orleans Hornets", "NOK": "New Orleans/Oklahoma City Hornets",
}
TEAM_NAMES = CURRENT_TEAMS | HISTORICAL_TEAMS
ALIASES = {"BRK": "BKN", "GS": "GSW", "NO": "NOP", "NY": "NYK", "PHO": "PHX", "SA": "SAS", "UTAH": "UTA", "WSH": "WAS", "NJ": "NJN"}
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")
SEASON_TYPES = {"2": ("RS", "Regular Season"), "4": ("PO", "Playoffs"), "5": ("PI", "Play-In")}
