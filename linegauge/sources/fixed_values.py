"""Fixed values. Results depend on these names, ids and thresholds being exactly so."""

# Odds scope. At most the first five sportsbooks of a list are taken.
SPORTSBOOKS = ["betrivers", "bovada", "hard_rock", "pinnacle", "draftkings"]

# Markets in scope.
MARKETS = [
    "moneyline",
    "total_games",
    "total_break_points",
    "player_break_points_won",
    "total_tie_breaks",
    "total_double_faults",
    "total_aces",
    "total_sets",
    "player_sets_won",
    "player_first_serve_percentage",
    "total_breaks",
    "player_aces",
    "player_games_won",
    "player_aces_+_double_faults",
    "player_double_faults",
    "1st_set_total_games",
    "1st_set_player_aces",
    "1st_set_player_games_won",
    "1st_set_total_aces",
    "1st_set_total_breaks",
]

# Rounds of one event, in playing order.
ROUNDS = [
    "round of 128",
    "round of 64",
    "round of 32",
    "round of 16",
    "quarterfinals",
    "semifinals",
    "finals",
]


# Competition categories to keep.
INCLUDED_CATEGORIES = [
    ("sr:category:3", "ATP"),
    ("sr:category:6", "WTA"),
    ("sr:category:76", "Davis Cup"),
    ("sr:category:74", "Billie Jean King Cup"),
]

# Kept categories whose competitions carry no level.
TEAM_CUP_CATEGORIES = ["sr:category:76", "sr:category:74"]

# Competition categories to leave out (id, name, may be kept on request, reason).
EXCLUDED_CATEGORIES = [
    ("sr:category:785", "ITF Men", False, "lower tier"),
    ("sr:category:213", "ITF Women", False, "lower tier"),
    ("sr:category:72", "Challenger", False, "development tier"),
    ("sr:category:871", "WTA 125K", False, "secondary tier"),
    ("sr:category:2516", "UTR Men", False, "amateur"),
    ("sr:category:2517", "UTR Women", False, "amateur"),
    ("sr:category:79", "Exhibition", False, "exhibition"),
    ("sr:category:1474", "Juniors", False, "juniors"),
    ("sr:category:1476", "Wheelchairs", False, "wheelchair"),
    ("sr:category:1475", "Legends", False, "legends"),
    ("sr:category:2400", "Wheelchairs Juniors", False, "wheelchair juniors"),
    ("sr:category:181", "Hopman Cup", True, "mixed exhibition"),
    ("sr:category:1012", "IPTL", False, "defunct"),
    ("sr:category:2414", "United Cup", True, "mixed team event"),
]

# Levels of the biggest tour events.
TOP_LEVELS = [
    "grand_slam",
    "atp_1000",
    "atp_500",
    "atp_world_tour_finals",
    "wta_1000",
    "wta_500",
    "wta_championships",
]

# Competition ids (number after "sr:competition:") of the main tournaments.
# MS / WS singles, MD / WD doubles, XD mixed doubles, TEAM for the national team cups.
TOURNAMENTS = [
    ("Australian Open", {"MS": [2567], "WS": [2571], "MD": [2569], "WD": [2573], "XD": [2575]}),
    ("French Open", {"MS": [2579], "WS": [2583], "MD": [2581], "WD": [2585], "XD": [2587]}),
    ("Wimbledon", {"MS": [2555], "WS": [2559], "MD": [2557], "WD": [2561], "XD": [2563]}),
    ("US Open", {"MS": [2591], "WS": [2595], "MD": [2593], "WD": [2597], "XD": [2599]}),
    ("Indian Wells", {"MS": [2739], "MD": [2741], "WS": [4589], "WD": [4591]}),
    ("Miami", {"MS": [2745], "MD": [2747], "WS": [4691], "WD": [4693]}),
    ("Monte Carlo", {"MS": [3121], "MD": [3123]}),
    ("Madrid", {"MS": [2787], "MD": [2789], "WS": [4925], "WD": [4927]}),
    ("Rome", {"MS": [2781], "MD": [2783], "WS": [4775], "WD": [4777]}),
    ("Canada", {"MS": [2995, 8285], "MD": [2997, 8287], "WS": [8279, 2977], "WD": [8281, 2979]}),
    ("Cincinnati", {"MS": [2983], "MD": [2985], "WS": [8363], "WD": [8365]}),
    ("Shanghai", {"MS": [3085], "MD": [3087]}),
    ("Paris", {"MS": [2661], "MD": [2663]}),
    ("ATP Finals", {"MS": [21406], "MD": [21408]}),
    ("WTA Finals", {"WS": [21422], "WD": [21424]}),
    ("Davis Cup", {"TEAM": [2100]}),
    ("Billie Jean King Cup", {"TEAM": [2102]}),
    ("Olympics", {"MS": [8183], "MD": [8185], "WS": [8187], "WD": [8189], "XD": [8191]}),
    ("Halle", {"MS": [2859], "MD": [2861]}),
    ("Dubai", {"MS": [2667], "MD": [2669], "WS": [4489], "WD": [4491]}),
    ("Barcelona", {"MS": [2769], "MD": [2771]}),
    ("Washington", {"MS": [2971], "MD": [2973], "WS": [8177], "WD": [8179]}),
    ("Beijing", {"MS": [3025], "MD": [3027], "WS": [8843], "WD": [8845]}),
    ("Tokyo", {"MS": [3031], "MD": [3033], "WS": [5943], "WD": [5945]}),
    ("Vienna", {"MS": [3103], "MD": [3105]}),
    ("Basel", {"MS": [2613], "MD": [2615]}),
    ("Acapulco", {"MS": [2709], "MD": [2711]}),
]

# Segment rules on the pregame line. First match wins, the last row takes the rest.
# (upper end, upper end belongs to the segment, code, label)
GAMES_SEGMENTS = [
    (7.5, True, "Bo3_lopsided", "Bo3_lopsided (pregame: ≤7.5)"),
    (12.0, True, "Bo3_underdog", "Bo3_underdog (pregame: 8-12)"),
    (13.0, True, "Bo3_competitive", "Bo3_competitive (pregame: 12.5-13)"),
    (18.5, True, "Ambiguous", "Ambiguous (pregame: 13.5-18.5)"),
    (None, True, "Bo5_likely", "Bo5_likely (pregame: ≥19)"),
]
FANTASY_SEGMENTS = [
    (10.0, True, "Q1", "Q1"),
    (13.5, True, "Q2", "Q2"),
    (19.0, True, "Q3", "Q3"),
    (23.0, True, "Q4", "Q4"),
    (None, True, "Q5", "Q5"),
]
FORMAT_SEGMENTS = [
    (13.5, False, "BO3_likely", "BO3_likely"),
    (19.5, True, "Ambiguous", "Ambiguous"),
    (None, True, "BO5_likely", "BO5_likely"),
]

# Proposed line ranges, low < line <= high. (name, low, high)
GAMES_RANGES = [
    ("Seg 1: ≤7.5", 0.0, 7.75),
    ("Seg 2: 8-12", 7.75, 12.25),
    ("Seg 3: 12.5-13", 12.25, 13.25),
    ("Seg 4: 13.5-18.5", 13.25, 18.75),
    ("Seg 5: ≥19", 18.75, 100.0),
]
FANTASY_RANGES = [
    ("Seg 1: ≤10.75", -9.0, 10.25),
    ("Seg 2: 10.75-13.75", 10.25, 13.75),
    ("Seg 3: 13.75-19.25", 13.75, 19.25),
    ("Seg 4: 19.25-23.25", 19.25, 23.25),
    ("Seg 5: ≥23.25", 23.25, 50.0),
]

# Bias classes of a line, by median percentile (code, shown text).
LINE_BIAS_TEXT = {
    "strong_over_predict": "⬇️ Strong over-predict",
    "slight_over_predict": "⬇️ Slight over-predict",
    "strong_under_predict": "⬆️ Strong under-predict",
    "slight_under_predict": "⬆️ Slight under-predict",
    "well_calibrated": "✓ Well-calibrated",
}
