"""Fixed values of the event model.

These numbers must equal the source data's codes for the metrics to be right;
they are listed here together, in natural order, and used by name everywhere else.
"""

# --- fixed values: event type ids -------------------------------------------
EVENT_DUEL = 1
EVENT_FOUL = 2
EVENT_FREE_KICK = 3
EVENT_PASS = 8
EVENT_SHOT = 10

# --- fixed values: sub-event ids --------------------------------------------
SUB_EVENT_PENALTY = 35

# --- fixed values: tag ids --------------------------------------------------
TAG_GOAL = 101
TAG_OWN_GOAL = 102
TAG_KEY_PASS = 302
TAG_DUEL_LOST = 701
TAG_DUEL_NEUTRAL = 702
TAG_DUEL_WON = 703
TAG_ACCURATE = 1801
TAG_NOT_ACCURATE = 1802

# --- fixed values: players, squads, ratings ---------------------------------
SYSTEM_PLAYER_ID = "0"          # events of the system player are dropped
DRAW_TEAM_ID = "0"              # winner id of a drawn match
DRAW_LABEL = "DRAW"
FULL_MATCH_MINUTES = 90
FULL_MATCH_BONUS = 1.05         # contribution factor for exactly 90 minutes
FOUL_PENALTY = 0.0005           # performance loss per foul
OWN_GOAL_PENALTY = 0.05         # performance loss per own goal
INITIAL_RATING = 0.5            # rating before a player's first match
INITIAL_CHEMISTRY = 0.5         # chemistry of a pair before any shared match
EXPERIENCE_THRESHOLD = 5        # matches separating the player and group routes
STRENGTH_DIVISOR = 11           # team strength divisor, whatever the lineup size

# --- fixed values: lineup rules ---------------------------------------------
ROLES = ("GK", "DF", "MD", "FW")
MIN_DEFENDERS = 2
MIN_MIDFIELDERS = 2
MIN_FORWARDS = 1
REQUIRED_GOALKEEPERS = 1

# --- fixed values: request kinds --------------------------------------------
REQUEST_FORECAST = 1            # req_type 1
REQUEST_PROFILE = 2             # req_type 2
INVALID = "Invalid"
UNRATED = "Unrated"           # our own: a named player without a rating or chemistry
