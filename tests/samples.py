"""Sample rows with known answers, as delimited text.

Fixed values: the rows that the answers in test_samples.py belong to, in natural order.
"""

STUDENT = """\
001,彭于晏,1995-05-16,男
002,胡歌,1994-03-20,男
003,周杰伦,1995-04-30,男
004,刘德华,1998-08-28,男
005,唐国强,1993-09-10,男
006,陈道明,1992-11-12,男
007,陈坤,1999-04-09,男
008,吴京,1994-02-06,男
009,郭德纲,1992-12-05,男
010,于谦,1998-08-23,男
011,潘长江,1995-05-27,男
012,杨紫,1996-12-21,女
013,蒋欣,1997-11-08,女
014,赵丽颖,1990-01-09,女
015,刘亦菲,1993-01-14,女
016,周冬雨,1990-06-18,女
017,范冰冰,1992-07-04,女
018,李冰冰,1993-09-24,女
019,邓紫棋,1994-08-31,女
020,宋丹丹,1991-03-01,女
"""

COURSE = """\
01,语文,1003
02,数学,1001
03,英语,1004
04,体育,1002
05,音乐,1002
"""

TEACHER = """\
1001,张高数
1002,李体音
1003,王子文
1004,刘丽英
"""

SCORE = """\
001,01,94
002,01,74
004,01,85
005,01,64
006,01,71
007,01,48
008,01,56
009,01,75
010,01,84
011,01,61
012,01,44
013,01,47
014,01,81
015,01,90
016,01,71
017,01,58
018,01,38
019,01,46
020,01,89
001,02,63
002,02,84
004,02,93
005,02,44
006,02,90
007,02,55
008,02,34
009,02,78
010,02,68
011,02,49
012,02,74
013,02,35
014,02,39
015,02,48
016,02,89
017,02,34
018,02,58
019,02,39
020,02,59
001,03,79
002,03,87
004,03,89
005,03,99
006,03,59
007,03,70
008,03,39
009,03,60
010,03,47
011,03,70
012,03,62
013,03,93
014,03,32
015,03,84
016,03,71
017,03,55
018,03,49
019,03,93
020,03,81
001,04,54
002,04,100
004,04,59
005,04,85
007,04,63
009,04,79
010,04,34
013,04,69
014,04,40
016,04,94
017,04,34
020,04,50
005,05,85
007,05,63
009,05,79
015,05,59
018,05,87
"""

SKU = """\
1,xiaomi 10,1,2020-01-01,2000
2,手机壳,1,2020-02-01,10
3,apple 12,1,2020-03-01,5000
4,xiaomi 13,1,2020-04-01,6000
5,破壁机,2,2020-01-01,500
6,洗碗机,2,2020-02-01,2000
7,热水壶,2,2020-03-01,100
8,微波炉,2,2020-04-01,600
9,自行车,3,2020-01-01,1000
10,帐篷,3,2020-02-01,100
11,烧烤架,3,2020-02-01,50
12,遮阳伞,3,2020-03-01,20
"""

ORDERS = """\
1,101,2021-09-27,29000.00
2,101,2021-09-28,70500.00
3,101,2021-09-29,43300.00
4,101,2021-09-30,860.00
5,102,2021-10-01,46180.00
6,102,2021-10-01,50000.00
7,102,2021-10-01,75500.00
8,102,2021-10-02,6170.00
9,103,2021-10-02,18580.00
10,103,2021-10-02,28000.00
11,103,2021-10-02,23400.00
12,103,2021-10-03,5910.00
13,104,2021-10-03,13000.00
14,104,2021-10-03,69500.00
15,104,2021-10-03,2000.00
16,104,2021-10-03,5380.00
17,105,2021-10-04,6210.00
18,105,2021-10-04,68000.00
19,105,2021-10-04,43100.00
20,105,2021-10-04,2790.00
21,106,2021-10-04,9390.00
22,106,2021-10-05,58000.00
23,106,2021-10-05,46600.00
24,106,2021-10-05,5160.00
25,107,2021-10-05,55350.00
26,107,2021-10-05,14500.00
27,107,2021-10-06,47400.00
28,107,2021-10-06,6900.00
29,108,2021-10-06,56570.00
30,108,2021-10-06,44500.00
31,108,2021-10-07,50800.00
32,108,2021-10-07,3900.00
33,109,2021-10-07,41480.00
34,109,2021-10-07,88000.00
35,109,2020-10-08,15000.00
36,109,2020-10-08,9020.00
37,1010,2020-10-08,9260.00
38,1010,2020-10-08,12000.00
39,1010,2020-10-08,23900.00
40,1010,2020-10-08,6790.00
"""

ORDER_DETAIL = """\
1,1,1,2021-09-27,2000.00,2
2,1,3,2021-09-27,5000.00,5
3,2,4,2021-09-28,6000.00,9
4,2,5,2021-09-28,500.00,33
5,3,7,2021-09-29,100.00,37
6,3,8,2021-09-29,600.00,46
7,3,9,2021-09-29,1000.00,12
8,4,12,2021-09-30,20.00,43
9,5,1,2021-10-01,2000.00,8
10,5,2,2021-10-01,10.00,18
11,5,3,2021-10-01,5000.00,6
12,6,4,2021-10-01,6000.00,8
13,6,6,2021-10-01,2000.00,1
14,7,7,2021-10-01,100.00,17
15,7,8,2021-10-01,600.00,48
16,7,9,2021-10-01,1000.00,45
17,8,10,2021-10-02,100.00,48
18,8,11,2021-10-02,50.00,15
19,8,12,2021-10-02,20.00,31
20,9,1,2021-09-30,2000.00,9
21,9,2,2021-10-02,10.00,5800
22,10,4,2021-10-02,6000.00,1
23,10,5,2021-10-02,500.00,24
24,10,6,2021-10-02,2000.00,5
25,11,8,2021-10-02,600.00,39
26,12,10,2021-10-03,100.00,47
27,12,11,2021-10-03,50.00,19
28,12,12,2021-10-03,20.00,13000
29,13,1,2021-10-03,2000.00,4
30,13,3,2021-10-03,5000.00,1
31,14,4,2021-10-03,6000.00,5
32,14,5,2021-10-03,500.00,47
33,14,6,2021-10-03,2000.00,8
34,15,7,2021-10-03,100.00,20
35,16,10,2021-10-03,100.00,22
36,16,11,2021-10-03,50.00,42
37,16,12,2021-10-03,20.00,7400
38,17,1,2021-10-04,2000.00,3
39,17,2,2021-10-04,10.00,21
40,18,4,2021-10-04,6000.00,8
41,18,5,2021-10-04,500.00,28
42,18,6,2021-10-04,2000.00,3
43,19,7,2021-10-04,100.00,55
44,19,8,2021-10-04,600.00,11
45,19,9,2021-10-04,1000.00,31
46,20,11,2021-10-04,50.00,45
47,20,12,2021-10-04,20.00,27
48,21,1,2021-10-04,2000.00,2
49,21,2,2021-10-04,10.00,39
50,21,3,2021-10-04,5000.00,1
51,22,4,2021-10-05,6000.00,8
52,22,5,2021-10-05,500.00,20
53,23,7,2021-10-05,100.00,58
54,23,8,2021-10-05,600.00,18
55,23,9,2021-10-05,1000.00,30
56,24,10,2021-10-05,100.00,27
57,24,11,2021-10-05,50.00,28
58,24,12,2021-10-05,20.00,53
59,25,1,2021-10-05,2000.00,5
60,25,2,2021-10-05,10.00,35
61,25,3,2021-10-05,5000.00,9
62,26,4,2021-10-05,6000.00,1
63,26,5,2021-10-05,500.00,13
64,26,6,2021-10-05,2000.00,1
65,27,7,2021-10-06,100.00,30
66,27,8,2021-10-06,600.00,19
67,27,9,2021-10-06,1000.00,33
68,28,10,2021-10-06,100.00,37
69,28,11,2021-10-06,50.00,46
70,28,12,2021-10-06,20.00,45
71,29,1,2021-10-06,2000.00,8
72,29,2,2021-10-06,10.00,57
73,29,3,2021-10-06,5000.00,8
74,30,4,2021-10-06,6000.00,3
75,30,5,2021-10-06,500.00,33
76,30,6,2021-10-06,2000.00,5
77,31,8,2021-10-07,600.00,13
78,31,9,2021-10-07,1000.00,43
79,32,10,2021-10-07,100.00,24
80,32,11,2021-10-07,50.00,30
81,33,1,2021-10-07,2000.00,8
82,33,2,2021-10-07,10.00,48
83,33,3,2021-10-07,5000.00,5
84,34,4,2021-10-07,6000.00,10
85,34,5,2021-10-07,500.00,44
86,34,6,2021-10-07,2000.00,3
87,35,8,2020-10-08,600.00,25
88,36,10,2020-10-08,100.00,57
89,36,11,2020-10-08,50.00,44
90,36,12,2020-10-08,20.00,56
91,37,1,2020-10-08,2000.00,2
92,37,2,2020-10-08,10.00,26
93,37,3,2020-10-08,5000.00,1
94,38,6,2020-10-08,2000.00,6
95,39,7,2020-10-08,100.00,35
96,39,8,2020-10-08,600.00,34
97,40,10,2020-10-08,100.00,37
98,40,11,2020-10-08,50.00,51
99,40,12,2020-10-08,20.00,27
"""

LOGIN = """\
101,180.149.130.161,2021-09-21 08:00:00,2021-09-27 08:30:00
101,180.149.130.161,2021-09-27 08:00:00,2021-09-27 08:30:00
101,180.149.130.161,2021-09-28 09:00:00,2021-09-28 09:10:00
101,180.149.130.161,2021-09-29 13:30:00,2021-09-29 13:50:00
101,180.149.130.161,2021-09-30 20:00:00,2021-09-30 20:10:00
102,120.245.11.2,2021-09-22 09:00:00,2021-09-27 09:30:00
102,120.245.11.2,2021-10-01 08:00:00,2021-10-01 08:30:00
102,180.149.130.174,2021-10-01 07:50:00,2021-10-01 08:20:00
102,120.245.11.2,2021-10-02 08:00:00,2021-10-02 08:30:00
103,27.184.97.3,2021-09-23 10:00:00,2021-09-27 10:30:00
103,27.184.97.3,2021-10-03 07:50:00,2021-10-03 09:20:00
104,27.184.97.34,2021-09-24 11:00:00,2021-09-27 11:30:00
104,27.184.97.34,2021-10-03 07:50:00,2021-10-03 08:20:00
104,27.184.97.34,2021-10-03 08:50:00,2021-10-03 10:20:00
104,120.245.11.89,2021-10-03 08:40:00,2021-10-03 10:30:00
105,119.180.192.212,2021-10-04 09:10:00,2021-10-04 09:30:00
106,119.180.192.66,2021-10-04 08:40:00,2021-10-04 10:30:00
106,119.180.192.66,2021-10-05 21:50:00,2021-10-05 22:40:00
107,219.134.104.7,2021-09-25 12:00:00,2021-09-27 12:30:00
107,219.134.104.7,2021-10-05 22:00:00,2021-10-05 23:00:00
107,219.134.104.7,2021-10-06 09:10:00,2021-10-06 10:20:00
107,27.184.97.46,2021-10-06 09:00:00,2021-10-06 10:00:00
108,101.227.131.22,2021-10-06 09:00:00,2021-10-06 10:00:00
108,101.227.131.22,2021-10-06 22:00:00,2021-10-06 23:00:00
109,101.227.131.29,2021-09-26 13:00:00,2021-09-27 13:30:00
109,101.227.131.29,2021-10-06 08:50:00,2021-10-06 10:20:00
109,101.227.131.29,2021-10-08 09:00:00,2021-10-08 09:10:00
1010,119.180.192.10,2021-09-27 14:00:00,2021-09-27 14:30:00
1010,119.180.192.10,2021-10-09 08:50:00,2021-10-09 10:20:00
"""

PRICE_CHANGE = """\
1,1900,2021-09-25
1,2000,2021-09-26
2,80,2021-09-29
2,10,2021-09-30
3,4999,2021-09-25
3,5000,2021-09-26
4,5600,2021-09-26
4,6000,2021-09-27
5,490,2021-09-27
5,500,2021-09-28
6,1988,2021-09-30
6,2000,2021-10-01
7,88,2021-09-28
7,100,2021-09-29
8,800,2021-09-28
8,600,2021-09-29
9,1100,2021-09-27
9,1000,2021-09-28
10,90,2021-10-01
10,100,2021-10-02
11,66,2021-10-01
11,50,2021-10-02
12,35,2021-09-28
12,20,2021-09-29
"""

DELIVERY = """\
1,1,101,2021-09-27,2021-09-29
2,2,101,2021-09-28,2021-09-28
3,3,101,2021-09-29,2021-09-30
4,4,101,2021-09-30,2021-10-01
5,5,102,2021-10-01,2021-10-01
6,6,102,2021-10-01,2021-10-01
7,7,102,2021-10-01,2021-10-03
8,8,102,2021-10-02,2021-10-02
9,9,103,2021-10-02,2021-10-03
10,10,103,2021-10-02,2021-10-04
11,11,103,2021-10-02,2021-10-02
12,12,103,2021-10-03,2021-10-03
13,13,104,2021-10-03,2021-10-04
14,14,104,2021-10-03,2021-10-04
15,15,104,2021-10-03,2021-10-03
16,16,104,2021-10-03,2021-10-03
17,17,105,2021-10-04,2021-10-04
18,18,105,2021-10-04,2021-10-06
19,19,105,2021-10-04,2021-10-06
20,20,105,2021-10-04,2021-10-04
21,21,106,2021-10-04,2021-10-04
22,22,106,2021-10-05,2021-10-05
23,23,106,2021-10-05,2021-10-05
24,24,106,2021-10-05,2021-10-07
25,25,107,2021-10-05,2021-10-05
26,26,107,2021-10-05,2021-10-06
27,27,107,2021-10-06,2021-10-06
28,28,107,2021-10-06,2021-10-07
29,29,108,2021-10-06,2021-10-06
30,30,108,2021-10-06,2021-10-06
31,31,108,2021-10-07,2021-10-09
32,32,108,2021-10-07,2021-10-09
33,33,109,2021-10-07,2021-10-08
34,34,109,2021-10-07,2021-10-08
35,35,109,2021-10-08,2021-10-10
36,36,109,2021-10-08,2021-10-09
37,37,1010,2021-10-08,2021-10-10
38,38,1010,2021-10-08,2021-10-10
39,39,1010,2021-10-08,2021-10-09
40,40,1010,2021-10-08,2021-10-09
"""

LIVE = """\
100,1,2021-12-01 19:00:00,2021-12-01 19:28:00
100,1,2021-12-01 19:30:00,2021-12-01 19:53:00
100,2,2021-12-01 21:01:00,2021-12-01 22:00:00
101,1,2021-12-01 19:05:00,2021-12-01 20:55:00
101,2,2021-12-01 21:05:00,2021-12-01 21:58:00
102,1,2021-12-01 19:10:00,2021-12-01 19:25:00
102,2,2021-12-01 19:55:00,2021-12-01 21:00:00
102,3,2021-12-01 21:05:00,2021-12-01 22:05:00
104,1,2021-12-01 19:00:00,2021-12-01 20:59:00
104,2,2021-12-01 21:57:00,2021-12-01 22:56:00
105,2,2021-12-01 19:10:00,2021-12-01 19:18:00
106,3,2021-12-01 19:01:00,2021-12-01 21:10:00
"""

PAGE_VIEW = """\
100,home,1659950435
100,good_search,1659950446
100,good_list,1659950457
100,home,1659950541
100,good_detail,1659950552
100,cart,1659950563
101,home,1659950435
101,good_search,1659950446
101,good_list,1659950457
101,home,1659950541
101,good_detail,1659950552
101,cart,1659950563
102,home,1659950435
102,good_search,1659950446
102,good_list,1659950457
103,home,1659950541
103,good_detail,1659950552
103,cart,1659950563
"""

LOGIN_EVENTS = """\
100,2021-12-01 19:00:00
100,2021-12-01 19:30:00
100,2021-12-02 21:01:00
100,2021-12-03 11:01:00
101,2021-12-01 19:05:00
101,2021-12-01 21:05:00
101,2021-12-03 21:05:00
101,2021-12-05 15:05:00
101,2021-12-06 19:05:00
102,2021-12-01 19:55:00
102,2021-12-01 21:05:00
102,2021-12-02 21:57:00
102,2021-12-03 19:10:00
104,2021-12-04 21:57:00
104,2021-12-02 22:57:00
105,2021-12-01 10:01:00
"""

PROMOTION = """\
1,oppo,2021-06-05,2021-06-09
2,oppo,2021-06-11,2021-06-21
3,vivo,2021-06-05,2021-06-15
4,vivo,2021-06-09,2021-06-21
5,redmi,2021-06-05,2021-06-21
6,redmi,2021-06-09,2021-06-15
7,redmi,2021-06-17,2021-06-26
8,huawei,2021-06-05,2021-06-26
9,huawei,2021-06-09,2021-06-15
10,huawei,2021-06-17,2021-06-21
"""
