"""The ticketing tables as SQL over the star tables (same rules as ``sources.star``)."""

from __future__ import annotations

AS_OF = "2001-01-01 00:00:00"

_CTES = """
WITH RECURSIVE n_sup AS (SELECT greatest(count(*), 1) AS n FROM supplier),
Users AS (
  SELECT c_custkey AS UserID, c_name AS FullName,
    lower(c_name) || '@example.com' AS Email,
    '09' || lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INTEGER, '0') AS PhoneNumber,
    sha256(c_name) AS PasswordHex,
    CASE WHEN c_custkey % 100 = 0 THEN 'Admin' WHEN c_custkey % 25 = 0 THEN 'Staff'
      ELSE 'Customer' END AS UserType,
    c_acctbal >= 0 AS IsActive,
    TIMESTAMP '1995-01-01' + to_hours(c_custkey) AS CreatedAt
  FROM customer),
Stations AS (
  SELECT n_nationkey::BIGINT AS StationID, 'N' || n_nationkey AS StationCode,
    n_name AS StationName, n_name AS City, r_name AS Province,
    NULL::VARCHAR AS Address, n_nationkey % 10 <> 9 AS IsActive
  FROM nation JOIN region ON n_regionkey = r_regionkey),
Routes AS (
  SELECT 2 * n + k - 1 AS RouteID, 'N' || n || '-N' || ((n + 7 * k) % 25) AS RouteCode,
    n AS DepartureStationID, (n + 7 * k) % 25 AS ArrivalStationID,
    (100 + 10 * n + 50 * k)::DECIMAL(8,2) AS Distance,
    (((100 + 10 * n + 50 * k) * 6) // 5)::INTEGER AS EstimatedDuration, true AS IsActive
  FROM (SELECT n_nationkey::BIGINT AS n FROM nation), (VALUES (1::BIGINT), (2::BIGINT)) v(k)),
Trains AS (
  SELECT s_suppkey AS TrainID, 'T' || s_suppkey AS TrainCode, s_name AS TrainName,
    CASE s_suppkey % 3 WHEN 0 THEN 'SE' WHEN 1 THEN 'TN' ELSE 'SNT' END AS TrainType,
    (6 + s_suppkey % 7)::INTEGER AS TotalCoaches, s_acctbal >= 0 AS IsActive
  FROM supplier),
SeatClasses AS (
  SELECT row_number() OVER (ORDER BY p_type) AS SeatClassID, p_type AS ClassName,
    NULL::VARCHAR AS Description,
    (1.0 + 0.3 * (row_number() OVER (ORDER BY p_type) - 1))::DECIMAL(4,2) AS PriceMultiplier
  FROM (SELECT DISTINCT p_type FROM part)),
Coaches AS (
  SELECT regexp_extract(p_brand, '(\\d+)', 1)::BIGINT * 10 + SeatClassID AS CoachID,
    (regexp_extract(p_brand, '(\\d+)', 1)::BIGINT * 10 + SeatClassID) % (SELECT n FROM n_sup)
      AS TrainID,
    (regexp_extract(p_brand, '(\\d+)', 1)::BIGINT * 10 + SeatClassID)::INTEGER AS CoachNumber,
    SeatClassID, count(*)::INTEGER AS TotalSeats
  FROM part JOIN SeatClasses ON p_type = ClassName GROUP BY p_brand, SeatClassID),
Seats AS (
  SELECT p_partkey AS SeatID,
    regexp_extract(p_brand, '(\\d+)', 1)::BIGINT * 10 + SeatClassID AS CoachID,
    lpad(p_partkey::VARCHAR, greatest(4, length(p_partkey::VARCHAR))::INTEGER, '0') AS SeatNumber,
    CASE p_partkey % 3 WHEN 1 THEN 'Lower' WHEN 2 THEN 'Middle' ELSE 'Upper' END AS SeatType
  FROM part JOIN SeatClasses ON p_type = ClassName),
sched_ids AS (
  SELECT DISTINCT ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT * 10
    + o_custkey % 10 AS id FROM orders),
sched_times AS (
  SELECT id, id % 50 AS RouteID,
    make_date(1995 + (id // 10 + 1) // 12, (id // 10 + 1) % 12 + 1, 1)::TIMESTAMP
      + to_days((id % 28)::INTEGER) + to_hours(id % 24) AS dep
  FROM sched_ids),
Schedules AS (
  SELECT id AS ScheduleID, id % (SELECT n FROM n_sup) AS TrainID, st.RouteID,
    dep AS DepartureTime, dep + to_minutes(r.EstimatedDuration::BIGINT) AS ArrivalTime,
    (300000 + 50000 * (id % 10))::DECIMAL(10,2) AS BasePrice,
    CASE WHEN id % 20 = 0 THEN 'Cancelled' WHEN id % 20 = 1 THEN 'Delayed'
      WHEN dep + to_minutes(r.EstimatedDuration::BIGINT) < TIMESTAMP '{as_of}' THEN 'Completed'
      ELSE 'Scheduled' END AS Status,
    (350 - id % 100)::INTEGER AS AvailableSeats, dep - to_days(60) AS CreatedAt
  FROM sched_times st JOIN Routes r ON st.RouteID = r.RouteID),
Bookings AS (
  SELECT o_orderkey AS BookingID,
    'BK' || strftime(o_orderdate, '%Y%m%d')
      || lpad(o_orderkey::VARCHAR, greatest(8, length(o_orderkey::VARCHAR))::INTEGER, '0') AS BookingCode,
    o_custkey AS UserID,
    ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT * 10 + o_custkey % 10
      AS ScheduleID,
    o_orderdate + to_hours(o_orderkey % 24) AS BookingDate,
    (o_totalprice::DECIMAL(10,2) * 3)::DECIMAL(10,2) AS TotalAmount,
    CASE o_orderkey % 10 WHEN 7 THEN 'Pending' WHEN 8 THEN 'Refunded' WHEN 9 THEN 'Failed'
      ELSE 'Paid' END AS PaymentStatus,
    CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Completed' ELSE 'Cancelled' END
      AS BookingStatus,
    NULL::TIMESTAMP AS CancelledAt, NULL::VARCHAR AS CancellationReason
  FROM orders),
Tickets AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
      || strftime(l_shipdate, '%Y%m%d') AS TicketID,
    l_orderkey AS BookingID, l_partkey AS SeatID, 'Passenger ' || l_suppkey AS PassengerName,
    NULL::VARCHAR AS PassengerIDNumber, NULL::VARCHAR AS PassengerPhone,
    l_extendedprice::DECIMAL(10,2) AS TicketPrice,
    CASE WHEN l_returnflag = 'R' THEN 'Refunded'
      WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Used'
      WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Cancelled' ELSE 'Valid' END
      AS TicketStatus
  FROM lineitem),
Payments AS (
  SELECT o_orderkey AS PaymentID, o_orderkey AS BookingID,
    CASE WHEN o_orderkey % 6 = 0 THEN 'Cash' WHEN o_orderpriority = '1-URGENT' THEN 'Momo'
      WHEN o_orderpriority = '2-HIGH' THEN 'ZaloPay' WHEN o_orderpriority = '3-MEDIUM'
      THEN 'VNPay' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Visa' ELSE 'MasterCard' END
      AS PaymentMethod,
    'TX' || o_orderkey AS TransactionID,
    (o_totalprice::DECIMAL(10,2) * 3)::DECIMAL(10,2) AS Amount,
    CASE WHEN o_orderkey % 10 <> 9
      THEN o_orderdate + to_hours(o_orderkey % 24) + to_hours(1) END AS PaymentDate,
    CASE o_orderkey % 10 WHEN 7 THEN 'Pending' WHEN 9 THEN 'Failed' ELSE 'Success' END
      AS PaymentStatus,
    CASE o_orderkey % 10 WHEN 7 THEN NULL WHEN 9 THEN '05' ELSE '00' END AS ResponseCode,
    NULL::VARCHAR AS ResponseMessage
  FROM orders),
RefundPolicies AS (
  SELECT * FROM (VALUES
    (1, 72, 90.00::DECIMAL(5,2), 'Hoàn 90% nếu hủy trước 72 giờ'),
    (2, 48, 70.00::DECIMAL(5,2), 'Hoàn 70% nếu hủy trước 48 giờ'),
    (3, 24, 50.00::DECIMAL(5,2), 'Hoàn 50% nếu hủy trước 24 giờ'),
    (4, 12, 30.00::DECIMAL(5,2), 'Hoàn 30% nếu hủy trước 12 giờ'),
    (5, 0, 0.00::DECIMAL(5,2), 'Không hoàn nếu hủy trong vòng 12 giờ'))
    v(PolicyID, HoursBeforeDeparture, RefundPercentage, Description)),
Notifications AS (
  SELECT event_id AS NotificationID, user_id AS UserID,
    CASE WHEN event_id % 3 = 0 THEN event_id END AS BookingID,
    CASE event_type WHEN 'view' THEN 'Promotion' WHEN 'click' THEN 'Reminder'
      WHEN 'purchase' THEN 'Payment' WHEN 'signup' THEN 'Delay' ELSE 'Cancellation' END
      AS NotificationType,
    event_type AS Title, props AS Message, value >= 5 AS IsRead, ts AS SentAt,
    NULL::TIMESTAMP AS ScheduledFor
  FROM events)
"""

# wide forms that the oracles share: a trip, a place to sit, a booking with its ticket number
_WIDE = """
ends AS (
  SELECT way.* EXCLUDE (DepartureStationID, ArrivalStationID),
    a.StationID AS from_id, a.StationName AS DepartureStation, a.StationCode AS from_code,
    z.StationID AS to_id, z.StationName AS ArrivalStation, z.StationCode AS to_code
  FROM (SELECT * FROM Routes) AS way
  JOIN (SELECT StationID, StationName, StationCode FROM Stations) a ON a.StationID = DepartureStationID
  JOIN (SELECT StationID, StationName, StationCode FROM Stations) z ON z.StationID = ArrivalStationID),
trips AS (
  SELECT Schedules.* EXCLUDE (CreatedAt), ends.* EXCLUDE (RouteID, IsActive), TrainCode, TrainName
  FROM Schedules INNER JOIN ends USING (RouteID) INNER JOIN Trains USING (TrainID)),
places AS (
  SELECT Seats.*, CoachNumber, TrainID, SeatClassID, ClassName, PriceMultiplier
  FROM Seats INNER JOIN Coaches USING (CoachID) INNER JOIN SeatClasses USING (SeatClassID)),
ticket_counts AS (SELECT BookingID, count(*) AS nt FROM Tickets GROUP BY BookingID),
booked AS (
  SELECT Bookings.*, BookingDate::DATE AS day, coalesce(nt, 0) AS nt, greatest(nt, 1) AS w,
    if(PaymentStatus = 'Paid', TotalAmount, 0) AS paid,
    if(BookingStatus = 'Cancelled', TotalAmount, 0) AS lost
  FROM Bookings LEFT JOIN ticket_counts USING (BookingID)),
per_trip AS (
  SELECT ScheduleID, count(*) AS n, sum(nt) AS nt, sum(w) AS w, sum(TotalAmount) AS amount,
    sum(TotalAmount * w) AS amount_w, sum(paid) AS paid, sum(paid * w) AS paid_w
  FROM booked GROUP BY ScheduleID),
per_user AS (
  SELECT UserID, count(*) AS n, sum(paid) AS spent, max(BookingDate) AS latest,
    count(*) FILTER (PaymentStatus = 'Paid') AS paid_n,
    sum(nt) FILTER (PaymentStatus = 'Paid') AS paid_nt,
    sum(TotalAmount) FILTER (PaymentStatus = 'Paid') AS paid_sum,
    sum(TotalAmount * w) FILTER (PaymentStatus = 'Paid') AS paid_sum_w,
    max(BookingDate) FILTER (PaymentStatus = 'Paid') AS paid_latest
  FROM booked GROUP BY UserID)
"""


def with_wide(body: str, as_of: str = AS_OF) -> str:
    return with_tables(body, as_of, _WIDE)


def with_tables(body: str, as_of: str = AS_OF, extra: str = "") -> str:
    """``body`` with the table CTEs (and further ones, each ``name AS (...)``) before it."""
    more = f",\n{extra.strip()}\n" if extra.strip() else ""
    return _CTES.format(as_of=as_of).strip() + more + "\n" + body.strip()
