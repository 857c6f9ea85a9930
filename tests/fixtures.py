"""Sample inputs of the tests.

The sales rows and the CSV files are the tests' own; what they should give is
worked out in the tests, by plain Python or by hand.
"""

import datetime as dt

SALES_SCHEMA = ("order_id int, order_date date, customer_id string, region string, "
                "product string, quantity int, price int")

# a garden shop in spring: two orders on 6 and on 17 April, none on most days,
# customers who buy in several regions, a free sample, equal revenues
SALES = [
    (71, dt.date(2023, 4, 2), "ada", "Coast", "Spade", 3, 2450),
    (72, dt.date(2023, 4, 3), "ben", "Hills", "Seeds", 40, 120),
    (73, dt.date(2023, 4, 6), "ada", "Coast", "Barrow", 2, 8900),
    (74, dt.date(2023, 4, 6), "cat", "Hills", "Spade", 1, 2450),
    (75, dt.date(2023, 4, 8), "dov", "Plain", "Seeds", 0, 120),
    (76, dt.date(2023, 4, 9), "ada", "Plain", "Hose", 4, 3075),
    (77, dt.date(2023, 4, 12), "eli", "Coast", "Seeds", 65, 120),
    (78, dt.date(2023, 4, 13), "ben", "Hills", "Hose", 1, 3075),
    (79, dt.date(2023, 4, 15), "cat", "Marsh", "Barrow", 1, 8900),
    (80, dt.date(2023, 4, 17), "fay", "Coast", "Spade", 3, 2450),
    (81, dt.date(2023, 4, 17), "dov", "Plain", "Barrow", 3, 8900),
]

# --- fixed values: the rows that the published join results belong to --------
CUSTOMERS = [("C001", "Alex", "East"), ("C002", "Bob", "West"), ("C003", "Charlie", "South"),
             ("C004", "Diana", "East")]
ORDERS = [(1001, "C001", dt.date(2024, 1, 1)), (1002, "C002", dt.date(2024, 1, 2)),
          (1003, "C001", dt.date(2024, 1, 3)), (1004, "C003", dt.date(2024, 1, 4)),
          (1005, "C002", dt.date(2024, 1, 5))]
ITEMS = [(1001, "Keyboard", 2, 1500), (1001, "Mouse", 1, 500), (1002, "Monitor", 1, 12000),
         (1003, "Keyboard", 1, 1500), (1004, "Mouse", 3, 500), (1005, "Monitor", 2, 12000)]
# ---------------------------------------------------------------------------

# one missing quantity, one repeated row, a single region below 4,000
SHOP_CSV = """
order_id,region,product,quantity,price
31,Coast,Rake,4,1900
32,Hills,Rake,1,1900
33,Coast,Twine,,250
34,Plain,Barrow,1,8900
35,Hills,Twine,6,250
36,Hills,Barrow,2,8900
34,Plain,Barrow,1,8900
"""
SHOP_SCHEMA = "order_id int, region string, product string, quantity double, price double"

# two missing cells in one row, a negative and a zero amount, a repeated row
PAYMENTS_CSV = """
transaction_id,customer_id,amount,currency,status
p-1,ada,75,CHF,PAID
p-2,,,CHF,OPEN
p-3,ben,-20,SEK,PAID
p-4,cat,0,SEK,VOID
p-3,ben,-20,SEK,PAID
"""
LIMITS_CSV = """
transaction_id,price,quantity
at-medium,400,5
below-medium,1999,1
at-high,2500,4
above-high,10001,1
"""
PEOPLE_CSV = """
id,name,age,email
a,Noor,41,Noor@Garden.example
b,   ,30,blank@garden.example
c,Ola,zero,
d,Pim,0,pim@garden.example
"""
