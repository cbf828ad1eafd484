"""Input rows with results that can be checked by hand."""

FLIGHTS = [
    (1001, "Skynet Airways", "JFK", "LAX", 10, 5, 2475),
    (1002, "Sunwind Lines", "ORD", "SFO", -3, -5, 1846),
    (1003, "BlueJet", "ATL", "SEA", 0, 15, 2182),
    (1004, "Quantum Flyers", "DFW", "MIA", 5, 20, 1121),
    (1005, "Nebula Express", "BOS", "DEN", 12, 8, 1754),
    (1006, "Skynet Airways", "SEA", "ORD", -5, -2, 1721),
    (1007, "Sunwind Lines", "MIA", "ATL", 7, 4, 595),
    (1008, "BlueJet", "SFO", "BOS", 22, 18, 2704),
]
FLIGHT_SCHEMA = (
    "FLIGHT_ID int, AIRLINE string, ORIGIN string, DEST string, DEP_DELAY int, ARR_DELAY int, DISTANCE int"
)

DEPARTMENTS = [(10, "A", "Tokyo"), (20, "B", "Tokyo"), (30, "C", "Osaka"), (40, "D", None), (80, "E", "Kobe")]
EMPLOYEES = [
    (1, 10, "sato taro", 420000.0),
    (2, 20, "suzuki", 510000.0),
    (3, 30, "takahashi", 480000.0),
    (4, 40, "tanaka", 550000.0),
    (5, 20, "ito", 600000.0),
    (6, 20, "watanabe", 620000.0),
    (7, 40, "yamamoto", 530000.0),
    (8, 30, "Sasaki", None),
]
PROJECTS = [(101, 20, "2025-04-01"), (102, 40, "2025-05-01"), (103, 20, "2024-12-31"), (104, 10, "2025-01-01"), (105, 30, None)]
