"""Box scores under every name that sources give their columns."""

import pytest

from ledgerline.functions import columns as names
from ledgerline.sources import readers

ALIASES = [(target, word) for target, words in readers.BOX_COLUMNS.items() for word in words]


@pytest.mark.parametrize(("target", "word"), ALIASES)
def test_every_name_is_found(target, word):
    others = {t: w[0] for t, w in readers.BOX_COLUMNS.items() if t != target}
    columns = [*others.values(), word.upper()]
    assert names.mapping(columns, readers.BOX_COLUMNS, exact_only=readers.BOX_WHOLE)[target] == word.upper()


def test_names_of_other_sources(spark):
    df = spark.createDataFrame([("21.0", "7.0", "A B", "GSW", "12", "3", "2", "1", "4", "5")],
        ["GID", "personId", "PLAYER", "team", "FG3PA", "FG3PM", "TO", "personalFouls", "reboundsTotal", "teamId"])
    (r,) = readers.extracted_logs(df).collect()
    assert (r.game_id, r.player_id, r.player_name, r.team_abbr, r.team_id) == ("0000000021", "7", "A B", "GSW", "5")
    assert (r.fg3a, r.fg3m, r.tov, r.pf, r.reb, r.pts) == (12, 3, 2, 1, 4, None)


def test_whole_names_only():
    assert names.mapping(["teamId", "3pa_rank"], readers.BOX_COLUMNS, exact_only=readers.BOX_WHOLE)["team_abbr"] is None
    assert names.mapping(["teamId", "3pa_rank"], readers.BOX_COLUMNS, exact_only=readers.BOX_WHOLE)["fg3a"] is None


def test_the_table_of_box_scores():
    box = ["GAME_ID", "PLAYER_ID", "PTS", "REB", "AST", "MIN"]
    ids = ["GAME_ID", "PLAYER_ID", "TEAM_ID", "PTS", "REB"]
    assert readers.locate_box({"lineups": ids, "box": box}) == "box"
    assert readers.locate_box({"lineups": ids}) is None
    assert readers.locate_box({"teams": ["GAME_ID", "TEAM_ID", "PTS", "REB", "AST", "MIN", "FGA", "FTA"]}) is None
    assert readers.locate_box({"small": box, "large": box}, {"small": 1, "large": 2}) == "large"
