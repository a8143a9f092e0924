"""Schemas of the documents and records that the library reads and writes."""

from __future__ import annotations

#: One match document; unknown fields are ignored, missing ones read as null.
MATCH = """
    meta struct<data_version: string, created: string, revision: int>,
    info struct<balls_per_over: int, dates: array<string>, gender: string, match_type: string, team_type: string,
        season: string, overs: int, event: struct<name: string, match_number: int, stage: string>, teams: array<string>,
        players: map<string, array<string>>, registry: struct<people: map<string, string>>,
        toss: struct<winner: string, decision: string>, outcome: struct<winner: string>, city: string, venue: string>,
    innings array<struct<team: string, super_over: boolean, powerplays: array<struct<`from`: double, `to`: double, type: string>>,
        target: struct<runs: int, overs: double>, overs: array<struct<`over`: int, deliveries: array<struct<
            batter: string, bowler: string, non_striker: string,
            runs: struct<batter: int, extras: int, total: int, non_boundary: boolean>,
            extras: struct<wides: int, byes: int, legbyes: int, noballs: int, penalty: int>,
            wickets: array<struct<player_out: string, kind: string, fielders: array<struct<name: string, substitute: boolean>>>>>>>>>>
"""

RECORD = """
    schema_version int, match_id string, ball_id string, innings int, `over` int, ball_in_over int, legal_ball_number int,
    is_legal boolean, batting_team string, bowling_team string, striker struct<id: string, name: string>,
    non_striker struct<id: string, name: string>, bowler struct<id: string, name: string>,
    delivery struct<runs_batter: int, runs_extras: int, runs_total: int, extras: map<string, int>,
        wickets: array<struct<player_out_id: string, player_out_name: string, kind: string, credited_to_bowler: boolean>>>,
    state struct<score_runs: int, score_wickets: int, balls_left: int, current_run_rate: double, required_run_rate: double,
        target_runs: int, runs_required: int, striker_runs: int, striker_balls: int, bowler_runs: int, bowler_balls: int,
        bowler_wickets: int, bowler_on_hat_trick: boolean, partnership_runs: int, partnership_balls: int,
        last_deliveries: array<string>, phase: string, milestones: array<string>>, state_string string
"""

PAIR = "match_id string, ball_id string, persona string, bucket string, event string, state string, commentary string"

EXAMPLE = "schema_version int, match_id string, ball_id string, persona string, bucket string, split string, messages array<struct<role: string, content: string>>"
