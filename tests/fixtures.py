"""Fixed values of the published test cases."""

PAIR_SCHEMA = "PULocationID int, DOLocationID int, total_amount double"

PAIR_ROWS = [
    (150, 250, 3.3),
    (150, 251, 3.1),
    (149, 300, 3.0),
    (149, 251, 7.2),
    (150, 250, 2.5),
    (150, 252, 3.1),
]

PAIR_TOTALS = {
    (149, 251): 7.2,
    (150, 250): 5.8,
    (150, 251): 3.1,
    (150, 252): 3.1,
    (149, 300): 3.0,
}

NEIGHBOUR_TOTALS = {
    (149, 251): 19.2,
    (150, 251): 19.2,
    (150, 250): 16.1,
    (150, 252): 13.4,
    (149, 300): 3.0,
}

VERTEX_WEIGHTS = [
    10.0, 16.0, 20.0, 25.0, 7.0, 13.0, 22.0, 7.0, 9.0, 5.0, 18.0,
    28.0, 17.0, 3.0, 29.0, 23.0, 10.0, 12.0, 15.0, 17.0, 15.0, 12.0,
]

EDGES = [
    (0, 1), (1, 2), (2, 3), (4, 5), (5, 6), (5, 7), (6, 8), (7, 8), (8, 9),
    (10, 11), (11, 12), (12, 13), (13, 15), (10, 15), (10, 14), (16, 17), (16, 19),
    (19, 17), (17, 18), (19, 20), (18, 20), (18, 21), (20, 21),
]

# the linked trips of the 42-row file, and the one with the largest distance
TRIP_SCHEMA = (
    "tripId long, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
    "trip_distance double, PULocationID int, DOLocationID int"
)
TRIP_ROWS = [
    (0, "2019-09-01 00:06:48", "2019-09-01 00:25:46", 2.0, 186, 161),
    (1, "2019-09-01 00:29:17", "2019-09-01 00:57:54", 5.5, 161, 256),
    (15, "2019-09-01 00:18:37", "2019-09-01 00:22:20", 0.5, 79, 113),
    (16, "2019-09-01 00:23:00", "2019-09-01 00:35:27", 2.4, 113, 209),
    (17, "2019-09-01 00:46:27", "2019-09-01 01:17:52", 20.7, 132, 238),
    (29, "2019-09-01 00:13:52", "2019-09-01 00:33:40", 3.96, 162, 148),
    (30, "2019-09-01 00:38:33", "2019-09-01 00:56:43", 5.87, 148, 263),
    (31, "2019-09-01 00:23:40", "2019-09-01 00:39:01", 1.12, 100, 170),
    (32, "2019-09-01 00:41:18", "2019-09-01 00:54:05", 3.14, 170, 79),
    (33, "2019-09-01 00:00:18", "2019-09-01 00:20:41", 5.82, 114, 238),
    (34, "2019-09-01 00:24:25", "2019-09-01 00:27:37", 0.93, 238, 24),
    (38, "2019-08-31 23:57:29", "2019-09-01 00:16:18", 3.15, 114, 230),
    (39, "2019-09-01 00:18:03", "2019-09-01 00:26:23", 1.58, 230, 246),
    (40, "2019-09-01 00:03:26", "2019-09-01 00:04:49", 0.36, 24, 24),
    (41, "2019-09-01 00:06:00", "2019-09-01 00:08:42", 0.87, 24, 238),
]
TRIP_EDGES = {(0, 1), (15, 16), (29, 30), (31, 32), (33, 34), (38, 39), (40, 41)}
