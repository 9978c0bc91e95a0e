"""User agents that the event queries send, and what each one is.

Fixed values, in the order of ``user_agent.FIELDS``: browser and its version, system and its version, device, brand, model, and whether
it is mobile, a tablet, a PC, a bot and touch capable. They are written down from what the agents are, not from the rules.
"""

from __future__ import annotations

# The flags of common kinds of devices.
PHONE = (True, False, False, False, True)
TABLET = (False, True, False, False, True)
PC = (False, False, True, False, False)
BOT = (False, False, False, True, False)
PHONE_BOT = (True, False, False, True, True)
NOTHING = (False, False, False, False, False)
OTHER = ("Other", None, None)
MAC, IPHONE, IPAD = ("Mac", "Apple", "Mac"), ("iPhone", "Apple", "iPhone"), ("iPad", "Apple", "iPad")
SPIDER = ("Spider", "Spider", "Desktop")
NO_AGENT = ("Other", "", "Other", "", *OTHER, *NOTHING)

WEBKIT = "AppleWebKit/537.36 (KHTML, like Gecko)"
SAFARI = "AppleWebKit/605.1.15 (KHTML, like Gecko)"
WINDOWS, LINUX = "Mozilla/5.0 (Windows NT 10.0; Win64; x64)", "Mozilla/5.0 (X11; Linux x86_64)"
MACOS = "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7)"
IOS = "Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X)"

AGENTS = [
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_14_6) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/15.6.2 Safari/605.1.15",
     ("Safari", "15.6.2", "Mac OS X", "10.14.6", *MAC, *PC)),
    (f"{WINDOWS} {WEBKIT} Chrome/120.0.0.0 Safari/537.36",
     ("Chrome", "120.0.0", "Windows", "10", *OTHER, *PC)),
    ("Mozilla/5.0 (Windows NT 6.1; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/109.0.5414.120 Safari/537.36 Edg/109.0.1518.78",
     ("Edge", "109.0.1518", "Windows", "7", *OTHER, *PC)),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/17.2 Mobile/15E148 Safari/604.1",
     ("Mobile Safari", "17.2", "iOS", "17.2", *IPHONE, *PHONE)),
    ("Mozilla/5.0 (iPad; CPU OS 16_6_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/16.6 Mobile/15E148 Safari/604.1",
     ("Mobile Safari", "16.6", "iOS", "16.6.1", *IPAD, *TABLET)),
    (f"Mozilla/5.0 (Linux; Android 14; Pixel 8) {WEBKIT} Chrome/120.0.6099.144 Mobile Safari/537.36",
     ("Chrome Mobile", "120.0.6099", "Android", "14", "Pixel 8", "Google", "Pixel 8", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 13; SM-X700 Build/TP1A) {WEBKIT} Chrome/119.0.0.0 Safari/537.36",
     ("Chrome", "119.0.0", "Android", "13", "Samsung SM-X700", "Samsung", "SM-X700", *TABLET)),
    ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
     ("Firefox", "121.0", "Ubuntu", "", *OTHER, *PC)),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
     ("Googlebot", "2.1", "Other", "", *SPIDER, *BOT)),
    ("Mozilla/5.0 (compatible; YandexBot/3.0; +http://yandex.com/bots)",
     ("YandexBot", "3.0", "Other", "", *SPIDER, *BOT)),
    ("Opera/9.80 (Android; Opera Mini/36.2.2254/119.132; U; id) Presto/2.12.423 Version/12.16",
     ("Opera Mini", "36.2.2254", "Android", "", *OTHER, *PHONE)),
    (f"{LINUX} {WEBKIT} HeadlessChrome/118.0.5993.70 Safari/537.36",
     ("HeadlessChrome", "118.0.5993", "Linux", "", *OTHER, *PC)),
    ("Mozilla/5.0 (Linux; Android 10; K; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 "
     "Chrome/126.0.6478.71 Mobile Safari/537.36",
     ("Chrome Mobile WebView", "126.0.6478", "Android", "10", *OTHER, *PHONE)),
    ("unheard-of agent", NO_AGENT),
    # Desktop browsers.
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:124.0) Gecko/20100101 Firefox/124.0",
     ("Firefox", "124.0", "Windows", "10", *OTHER, *PC)),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10.15; rv:109.0) Gecko/20100101 Firefox/115.0",
     ("Firefox", "115.0", "Mac OS X", "10.15", *MAC, *PC)),
    (f"{MACOS} {WEBKIT} Chrome/122.0.0.0 Safari/537.36",
     ("Chrome", "122.0.0", "Mac OS X", "10.15.7", *MAC, *PC)),
    (f"{WINDOWS} {WEBKIT} Chrome/120.0.0.0 Safari/537.36 OPR/106.0.4998.70",
     ("Opera", "106.0.4998", "Windows", "10", *OTHER, *PC)),
    (f"{WINDOWS} {WEBKIT} Chrome/118.0.0.0 Safari/537.36 Vivaldi/6.4.3160.41",
     ("Vivaldi", "6.4.3160", "Windows", "10", *OTHER, *PC)),
    (f"{WINDOWS} {WEBKIT} Chrome/116.0.5845.837 YaBrowser/23.9.5.837 Yowser/2.5 Safari/537.36",
     ("Yandex Browser", "23.9.5", "Windows", "10", *OTHER, *PC)),
    (f"{WINDOWS} {WEBKIT} Chrome/118.0.5993.118 Whale/3.23.214.10 Safari/537.36",
     ("Whale", "3.23.214", "Windows", "10", *OTHER, *PC)),
    (f"{WINDOWS} {WEBKIT} Chrome/64.0.3282.140 Safari/537.36 Edge/18.17763",
     ("Edge", "18.17763", "Windows", "10", *OTHER, *PC)),
    ("Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko",
     ("IE", "11.0", "Windows", "7", *OTHER, *PC)),
    ("Mozilla/5.0 (compatible; MSIE 10.0; Windows NT 6.2; Trident/6.0)",
     ("IE", "10.0", "Windows", "8", *OTHER, *PC)),
    ("Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 5.1; Trident/4.0)",
     ("IE", "8.0", "Windows", "XP", *OTHER, *PC)),
    (f"Mozilla/5.0 (Windows NT 6.3; Win64; x64) {WEBKIT} Chrome/96.0.4664.110 Safari/537.36",
     ("Chrome", "96.0.4664", "Windows", "8.1", *OTHER, *PC)),
    ("Mozilla/5.0 (Windows NT 6.0; rv:52.0) Gecko/20100101 Firefox/52.0",
     ("Firefox", "52.0", "Windows", "Vista", *OTHER, *PC)),
    ("Opera/9.80 (Windows NT 6.1; WOW64) Presto/2.12.388 Version/12.18",
     ("Opera", "12.18", "Windows", "7", *OTHER, *PC)),
    ("Mozilla/5.0 (Windows NT 10.0; WOW64; rv:60.0) Gecko/20100101 Firefox/60.0 SeaMonkey/2.53.17",
     ("SeaMonkey", "2.53.17", "Windows", "10", *OTHER, *PC)),
    ("Mozilla/5.0 (X11; Linux x86_64; rv:102.0) Goanna/6.4 Firefox/102.0 PaleMoon/32.5.0",
     ("Pale Moon", "32.5.0", "Linux", "", *OTHER, *PC)),
    (f"{MACOS} {WEBKIT} Slack/4.35 Chrome/116.0.5845.188 Electron/26.2.4 Safari/537.36",
     ("Electron", "26.2.4", "Mac OS X", "10.15.7", *MAC, *PC)),
    (f"Mozilla/5.0 (X11; Linux x86_64) {WEBKIT} Ubuntu Chromium/83.0.4103.61 Chrome/83.0.4103.61 Safari/537.36",
     ("Chromium", "83.0.4103", "Ubuntu", "", *OTHER, *PC)),
    (f"Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) {WEBKIT} Chrome/121.0.0.0 Safari/537.36",
     ("Chrome", "121.0.0", "Chrome OS", "14541.0.0", *OTHER, *PC)),
    ("Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/117.0",
     ("Firefox", "117.0", "Fedora", "", *OTHER, *PC)),
    ("Mozilla/5.0 (X11; FreeBSD amd64; rv:107.0) Gecko/20100101 Firefox/107.0",
     ("Firefox", "107.0", "FreeBSD", "", *OTHER, *NOTHING)),
    ("Mozilla/5.0 (X11; Linux x86_64) KHTML/5.97.0 (like Gecko) Konqueror/5.97",
     ("Konqueror", "5.97", "Linux", "", *OTHER, *PC)),
    # Phones.
    (f"{IOS} {SAFARI} CriOS/121.0.6167.66 Mobile/15E148 Safari/604.1",
     ("Chrome Mobile iOS", "121.0.6167", "iOS", "17.2", *IPHONE, *PHONE)),
    (f"{IOS} {SAFARI} FxiOS/122.0 Mobile/15E148 Safari/605.1.15",
     ("Firefox iOS", "122.0", "iOS", "17.2", *IPHONE, *PHONE)),
    (f"{IOS} {SAFARI} Version/17.0 EdgiOS/120.0.2210.126 Mobile/15E148 Safari/605.1.15",
     ("Edge Mobile", "120.0.2210", "iOS", "17.2", *IPHONE, *PHONE)),
    (f"{IOS} {SAFARI} GSA/300.0.598994205 Mobile/15E148 Safari/604.1",
     ("Google", "300.0.598994205", "iOS", "17.2", *IPHONE, *PHONE)),
    (f"{IOS} {SAFARI} Mobile/15E148",
     ("Mobile Safari UI/WKWebView", "", "iOS", "17.2", *IPHONE, *PHONE)),
    (f"{IOS} {SAFARI} Mobile/15E148 Instagram 317.0.0.26.109 (iPhone14,5; iOS 17_2)",
     ("Instagram", "317.0.0", "iOS", "17.2", *IPHONE, *PHONE)),
    ("Mozilla/5.0 (iPod touch; CPU iPhone OS 12_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/12.1 "
     "Mobile/15E148 Safari/604.1",
     ("Mobile Safari", "12.1", "iOS", "12.5", "iPod", "Apple", "iPod", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 13; SM-S918B) {WEBKIT} SamsungBrowser/23.0 Chrome/115.0.0.0 Mobile Safari/537.36",
     ("Samsung Internet", "23.0", "Android", "13", "Samsung SM-S918B", "Samsung", "SM-S918B", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 13; Pixel 7 Pro Build/TQ3A) {WEBKIT} Chrome/116.0.0.0 Mobile Safari/537.36 EdgA/116.0.1938.72",
     ("Edge Mobile", "116.0.1938", "Android", "13", "Pixel 7 Pro", "Google", "Pixel 7 Pro", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 10; K) {WEBKIT} Chrome/120.0.0.0 Mobile Safari/537.36 OPR/79.0.0.0",
     ("Opera Mobile", "79.0.0", "Android", "10", *OTHER, *PHONE)),
    ("Mozilla/5.0 (Android 13; Mobile; rv:121.0) Gecko/121.0 Firefox/121.0",
     ("Firefox Mobile", "121.0", "Android", "13", *OTHER, *PHONE)),
    (f"Mozilla/5.0 (Linux; U; Android 12; en-US; Redmi Note 9 Pro Build/SKQ1) {WEBKIT} Version/4.0 Chrome/78.0.3904.108 "
     "UCBrowser/13.4.0.1306 Mobile Safari/537.36",
     ("UC Browser", "13.4.0", "Android", "12", "XiaoMi Redmi Note 9 Pro", "XiaoMi", "Redmi Note 9 Pro", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 11; POCO X3) {WEBKIT} Version/4.0 Chrome/100.0.4896.127 Mobile Safari/537.36 "
     "XiaoMi/MiuiBrowser/13.28.0",
     ("MiuiBrowser", "13.28.0", "Android", "11", "XiaoMi POCO X3", "XiaoMi", "POCO X3", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 10; HUAWEI ELE-L29) {WEBKIT} Chrome/99.0.4844.88 HuaweiBrowser/13.0.5.303 Mobile Safari/537.36",
     ("Huawei Browser", "13.0.5", "Android", "10", "Huawei ELE-L29", "Huawei", "ELE-L29", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 9; ONEPLUS A6003 Build/PKQ1) {WEBKIT} Chrome/88.0.4324.152 Mobile Safari/537.36",
     ("Chrome Mobile", "88.0.4324", "Android", "9", "OnePlus ONEPLUS A6003", "OnePlus", "ONEPLUS A6003", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 8.1.0; Nexus 6P Build/OPM7) {WEBKIT} Chrome/91.0.4472.120 Mobile Safari/537.36",
     ("Chrome Mobile", "91.0.4472", "Android", "8.1.0", "Nexus 6P", "Huawei", "Nexus 6P", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 12; CPH2211) {WEBKIT} Chrome/112.0.5615.136 Mobile Safari/537.36",
     ("Chrome Mobile", "112.0.5615", "Android", "12", "CPH2211", "Generic_Android", "CPH2211", *PHONE)),
    ("Mozilla/5.0 (Linux; U; Android 4.0.3; de-de; GT-I9100 Build/IML74K) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 "
     "Mobile Safari/534.30",
     ("Android", "4.0.3", "Android", "4.0.3", "Samsung GT-I9100", "Samsung", "GT-I9100", *PHONE)),
    (f"Mozilla/5.0 (Linux; Android 13; SM-A536B; wv) {WEBKIT} Version/4.0 Chrome/120.0.6099.43 Mobile Safari/537.36 "
     "[FB_IAB/FB4A;FBAV/443.0.0.23.229;]",
     ("Facebook", "443.0.0", "Android", "13", "Samsung SM-A536B", "Samsung", "SM-A536B", *PHONE)),
    (f"Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1; Microsoft; Lumia 950) {WEBKIT} Chrome/52.0.2743.116 Mobile Safari/537.36 "
     "Edge/15.15063",
     ("Edge Mobile", "15.15063", "Windows Phone", "10.0", "Lumia 950", "Nokia", "Lumia 950", *PHONE)),
    ("Mozilla/5.0 (Mobile; Nokia_8110_4G; rv:48.0) Gecko/48.0 Firefox/48.0 KAIOS/2.5",
     ("Firefox Mobile", "48.0", "KaiOS", "2.5", *OTHER, True, False, False, False, False)),
    # Tablets and consoles.
    (f"Mozilla/5.0 (Linux; Android 9; KFMAWI) {WEBKIT} Silk/108.4.6 like Chrome/108.0.5359.160 Safari/537.36",
     ("Amazon Silk", "108.4.6", "Android", "9", "Kindle", "Amazon", "Kindle", *TABLET)),
    (f"Mozilla/5.0 (Linux; Android 6.0.1; Nexus 7 Build/MOB30X) {WEBKIT} Chrome/85.0.4183.81 Safari/537.36",
     ("Chrome", "85.0.4183", "Android", "6.0.1", "Nexus 7", "Asus", "Nexus 7", *TABLET)),
    ("Mozilla/5.0 (PlayStation 4 10.50) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/13.0 Safari/605.1.15",
     ("Safari", "13.0", "Other", "", "PlayStation 4", "Sony", "PlayStation 4", *NOTHING)),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64; Xbox; Xbox One) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/117.0.0.0 "
     "Safari/537.36 Edg/117.0.2045.60",
     ("Edge", "117.0.2045", "Windows", "10", "Xbox One", "Microsoft", "Xbox One", *PC)),
    # Crawlers and programs.
    (f"Mozilla/5.0 (Linux; Android 6.0.1; Nexus 5X Build/MMB29P) {WEBKIT} Chrome/121.0.6167.85 Mobile Safari/537.36 "
     "(compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
     ("Googlebot", "2.1", "Android", "6.0.1", *SPIDER, *PHONE_BOT)),
    ("Googlebot-Image/1.0", ("Googlebot-Image", "1.0", "Other", "", *SPIDER, *BOT)),
    ("Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)", ("bingbot", "2.0", "Other", "", *SPIDER, *BOT)),
    ("Mozilla/5.0 (compatible; Baiduspider/2.0; +http://www.baidu.com/search/spider.html)",
     ("Baiduspider", "2.0", "Other", "", *SPIDER, *BOT)),
    ("facebookexternalhit/1.1 (+http://www.facebook.com/externalhit_uatext.php)", ("FacebookBot", "1.1", "Other", "", *SPIDER, *BOT)),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_5) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/13.1.1 Safari/605.1.15 "
     "(Applebot/0.1; +http://www.apple.com/go/applebot)",
     ("Applebot", "0.1", "Mac OS X", "10.15.5", *SPIDER, False, False, True, True, False)),
    ("Slackbot-LinkExpanding 1.0 (+https://api.slack.com/robots)", ("Slackbot-LinkExpanding", "1.0", "Other", "", *SPIDER, *BOT)),
    ("curl/8.4.0", ("curl", "8.4.0", "Other", "", *OTHER, *NOTHING)),
    ("Wget/1.21.3", ("Wget", "1.21.3", "Other", "", *OTHER, *NOTHING)),
    ("python-requests/2.31.0", ("Python Requests", "2.31.0", "Other", "", *OTHER, *NOTHING)),
    ("okhttp/4.12.0", ("okhttp", "4.12.0", "Other", "", *OTHER, *NOTHING)),
    ("Go-http-client/1.1", ("Go-http-client", "1.1", "Other", "", *OTHER, *NOTHING)),
]
