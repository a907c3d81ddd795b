"""Detection rules for browsers, systems and webmail referrers.

Order is meaning. Texts are compared in lower case.
"""

from typing import NamedTuple


class Browser(NamedTuple):
    name: str
    aliases: tuple[str, ...]
    excludes: tuple[str, ...]
    kind: str
    engine: str
    version: str


class System(NamedTuple):
    name: str
    parent: str | None
    aliases: tuple[str, ...]
    excludes: tuple[str, ...]
    device: str


# Fixed values. The first browser that fits names an agent.
BROWSERS = [
    Browser("360se", ("360SE",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("360ee", ("360EE", "JiSuBrowser"), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("QQBrowser", ("QQBrowser",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("Wechat", ("WindowsWechat",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("UBrowser", ("UBrowser",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("UBrowser", ("LBBROWSER",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("SeewoBrowser", ("SeewoBrowser",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("SLBrowser", ("SLBrowser",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("SLBrowser", ("BaiduClient",), (),
            "WEB_BROWSER", "GECKO", r""),
    Browser("Robot/Spider", (
        "Googlebot", "Mediapartners-Google", "Web Preview", "bot", "Applebot", "spider", "crawler", "Feedfetcher",
        "Slurp", "Twiceler", "Nutch", "BecomeBot", "bingbot", "BingPreview", "Google Web Preview",
        "WordPress.com mShots", "Seznam", "facebookexternalhit", "YandexMarket", "Teoma", "ThumbSniper", "Phantom",
        "Go-http-client", "Java/", "python-requests", "YandexBot", "AdsBot-Google", "AhrefsBot", "emulator",
    ), (),
            "ROBOT", "OTHER", r""),
    Browser("Outlook", ("MSOffice",), (),
            "EMAIL_CLIENT", "WORD", r"MSOffice (([0-9]+))"),
    Browser("Internet Explorer", ("MSIE", "Trident", "IE "), ("BingPreview", "Xbox", "Xbox One"),
            "WEB_BROWSER", "TRIDENT", r"MSIE (([\d]+)\.([\w]+))"),
    Browser("Microsoft Edge", ("Edge",), (),
            "WEB_BROWSER", "EDGE_HTML", r"(?:Edge\/(([0-9]+)\.([0-9]*)))"),
    Browser("Chrome", ("Chrome", "CrMo", "CriOS"), ("OPR/", "Web Preview", "Vivaldi"),
            "WEB_BROWSER", "WEBKIT", r"Chrome\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?(\.[\w]+)?)"),
    Browser("Omniweb", ("OmniWeb",), (),
            "WEB_BROWSER", "WEBKIT", r""),
    Browser("Firefox", ("Firefox", "FxiOS"), ("camino", "flock", "ggpht.com", "WordPress.com mShots"),
            "WEB_BROWSER", "GECKO", r"Firefox\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?(\.[\w]+)?)"),
    Browser("Safari", ("Safari",), ("bot", "preview", "OPR/", "Coast/", "Vivaldi", "CFNetwork", "Phantom"),
            "WEB_BROWSER", "WEBKIT", r"Version\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?)"),
    Browser("Opera", (" Coast/",), (),
            "MOBILE_BROWSER", "WEBKIT", r"Coast\/(([\d]+)\.([\w]+)?(\.[\w]+)?(\.[\w]+)?)"),
    Browser("Opera", (" OPR/", "Opera"), (),
            "WEB_BROWSER", "PRESTO", r"[o][p][e]?[r][a]?\/(([\d]+)\.([\w]+)(\.([\w]+))?(\.([\w]+))?)"),
    Browser("Konqueror", ("Konqueror",), ("Exabot",),
            "WEB_BROWSER", "KHTML", r"Konqueror\/(([0-9]+)\.?([\w]+)?(-[\w]+)?)"),
    Browser("Samsung Dolphin 2", ("Dolfin/2",), (),
            "MOBILE_BROWSER", "WEBKIT", r""),
    Browser("Apple WebKit", ("AppleWebKit",), ("bot", "preview", "OPR/", "Coast/", "Vivaldi", "Phantom"),
            "WEB_BROWSER", "WEBKIT", r""),
    Browser("Lotus Notes", ("Lotus-Notes",), (),
            "EMAIL_CLIENT", "OTHER", r"Lotus-Notes\/(([\d]+)\.([\w]+))"),
    Browser("Camino", ("Camino",), (),
            "WEB_BROWSER", "GECKO", r"Camino\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?)"),
    Browser("Flock", ("Flock",), (),
            "WEB_BROWSER", "GECKO", r"Flock\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?)"),
    Browser("Thunderbird", ("Thunderbird",), (),
            "EMAIL_CLIENT", "GECKO", r"Thunderbird\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?(\.[\w]+)?)"),
    Browser("Vivaldi", ("Vivaldi",), (),
            "WEB_BROWSER", "BLINK", r"Vivaldi/(([\d]+).([\d]+).([\d]+).([\d]+))"),
    Browser("SeaMonkey", ("SeaMonkey",), (),
            "WEB_BROWSER", "GECKO", r"SeaMonkey\/(([0-9]+)\.?([\w]+)?(\.[\w]+)?)"),
    Browser("Mozilla", ("Mozilla", "Moozilla"), ("ggpht.com",),
            "WEB_BROWSER", "OTHER", r""),
    Browser("CFNetwork", ("CFNetwork",), (),
            "UNKNOWN", "OTHER", r"CFNetwork/(([\d]+)(?:\.([\d]))?(?:\.([\d]+))?)"),
    Browser("Eudora", ("Eudora", "EUDORA"), (),
            "EMAIL_CLIENT", "OTHER", r""),
    Browser("PocoMail", ("PocoMail",), (),
            "EMAIL_CLIENT", "OTHER", r""),
    Browser("The Bat!", ("The Bat",), (),
            "EMAIL_CLIENT", "OTHER", r""),
    Browser("NetFront", ("NetFront",), (),
            "MOBILE_BROWSER", "OTHER", r""),
    Browser("Evolution", ("CamelHttpStream",), (),
            "EMAIL_CLIENT", "OTHER", r""),
    Browser("Lynx", ("Lynx",), (),
            "TEXT_BROWSER", "OTHER", r"Lynx\/(([0-9]+)\.([\d]+)\.?([\w\-+]+)?\.?([\w\-+]+)?)"),
    Browser("Downloading Tool", ("cURL", "wget", "ggpht.com", "Apache-HttpClient"), (),
            "TOOL", "OTHER", r""),
]

# Fixed values. A system fits when its own aliases and those of all its parents are found; children are
# tried before their parent. A parent is the nearest rule of that name above.
SYSTEMS = [
    System("Windows", None, ("Windows",), ("Palm", "ggpht.com"), "COMPUTER"),
    System("Windows 10", "Windows", ("Windows NT 6.4", "Windows NT 10"), (), "COMPUTER"),
    System("Windows 8.1", "Windows", ("Windows NT 6.3",), (), "COMPUTER"),
    System("Windows 8", "Windows", ("Windows NT 6.2",), ("Xbox", "Xbox One"), "COMPUTER"),
    System("Windows 7", "Windows", ("Windows NT 6.1",), ("Xbox", "Xbox One"), "COMPUTER"),
    System("Windows Vista", "Windows", ("Windows NT 6",), ("Xbox", "Xbox One"), "COMPUTER"),
    System("Windows 2000", "Windows", ("Windows NT 5.0",), (), "COMPUTER"),
    System("Windows XP", "Windows", ("Windows NT 5",), ("ggpht.com",), "COMPUTER"),
    System("Windows 10 Mobile", "Windows", ("Windows Phone 10",), (), "MOBILE"),
    System("Windows Phone 8.1", "Windows", ("Windows Phone 8.1",), (), "MOBILE"),
    System("Windows Phone 8", "Windows", ("Windows Phone 8",), (), "MOBILE"),
    System("Windows Phone 7", "Windows", ("Windows Phone OS 7",), (), "MOBILE"),
    System("Windows Mobile", "Windows", ("Windows CE",), (), "MOBILE"),
    System("Windows 98", "Windows", ("Windows 98", "Win98"), ("Palm",), "COMPUTER"),
    System("Xbox OS", "Windows", ("xbox",), (), "GAME_CONSOLE"),
    System("Android", None, ("Android",), ("Ubuntu",), "MOBILE"),
    System("Android 8.x", "Android", ("Android 8", "Android-8"), ("glass",), "MOBILE"),
    System("Android 8.x Tablet", "Android 8.x", ("Android 8", "Android-8"), ("mobile", "glass"), "TABLET"),
    System("Android 7.x", "Android", ("Android 7", "Android-7"), ("glass",), "MOBILE"),
    System("Android 7.x Tablet", "Android 7.x", ("Android 7", "Android-7"), ("mobile", "glass"), "TABLET"),
    System("Android 6.x", "Android", ("Android 6", "Android-6"), ("glass",), "MOBILE"),
    System("Android 6.x Tablet", "Android 6.x", ("Android 6", "Android-6"), ("mobile", "glass"), "TABLET"),
    System("Android 5.x", "Android", ("Android 5", "Android-5"), ("glass",), "MOBILE"),
    System("Android 5.x Tablet", "Android 5.x", ("Android 5", "Android-5"), ("mobile", "glass"), "TABLET"),
    System("Android 4.x", "Android", ("Android 4", "Android-4"), ("glass", "ubuntu"), "MOBILE"),
    System("Android 4.x Tablet", "Android 4.x", ("Android 4", "Android-4"), ("mobile", "glass", "ubuntu"), "TABLET"),
    System("Android 4.x", "Android", ("Android 4",), ("ubuntu",), "WEARABLE"),
    System("Android 3.x Tablet", "Android", ("Android 3",), (), "TABLET"),
    System("Android 2.x", "Android", ("Android 2",), (), "MOBILE"),
    System("Android 2.x Tablet", "Android 2.x", ("Kindle Fire", "GT-P1000", "SCH-I800"), (), "TABLET"),
    System("Android 1.x", "Android", ("Android 1",), (), "MOBILE"),
    System("Android Mobile", "Android", ("Mobile",), ("ubuntu",), "MOBILE"),
    System("Android Tablet", "Android", ("Tablet",), (), "TABLET"),
    System("Chrome OS", None, ("CrOS",), (), "COMPUTER"),
    System("WebOS", None, ("webOS",), (), "MOBILE"),
    System("PalmOS", None, ("Palm",), (), "MOBILE"),
    System("MeeGo", None, ("MeeGo",), (), "MOBILE"),
    System("iOS", None, ("iPhone", "like Mac OS X"), (), "MOBILE"),
    System("iOS 11 (iPhone)", "iOS", ("iPhone OS 11",), (), "MOBILE"),
    System("iOS 10 (iPhone)", "iOS", ("iPhone OS 10",), (), "MOBILE"),
    System("iOS 9 (iPhone)", "iOS", ("iPhone OS 9",), (), "MOBILE"),
    System("iOS 8.4 (iPhone)", "iOS", ("iPhone OS 8_4",), (), "MOBILE"),
    System("iOS 8.3 (iPhone)", "iOS", ("iPhone OS 8_3",), (), "MOBILE"),
    System("iOS 8.2 (iPhone)", "iOS", ("iPhone OS 8_2",), (), "MOBILE"),
    System("iOS 8.1 (iPhone)", "iOS", ("iPhone OS 8_1",), (), "MOBILE"),
    System("iOS 8 (iPhone)", "iOS", ("iPhone OS 8",), (), "MOBILE"),
    System("iOS 7 (iPhone)", "iOS", ("iPhone OS 7",), (), "MOBILE"),
    System("iOS 6 (iPhone)", "iOS", ("iPhone OS 6",), (), "MOBILE"),
    System("iOS 5 (iPhone)", "iOS", ("iPhone OS 5",), (), "MOBILE"),
    System("iOS 4 (iPhone)", "iOS", ("iPhone OS 4",), (), "MOBILE"),
    System("Mac OS X (iPad)", "iOS", ("iPad",), (), "TABLET"),
    System("iOS 11 (iPad)", "Mac OS X (iPad)", ("OS 11",), (), "TABLET"),
    System("iOS 10 (iPad)", "Mac OS X (iPad)", ("OS 10",), (), "TABLET"),
    System("iOS 9 (iPad)", "Mac OS X (iPad)", ("OS 9",), (), "TABLET"),
    System("iOS 8.4 (iPad)", "Mac OS X (iPad)", ("OS 8_4",), (), "TABLET"),
    System("iOS 8.3 (iPad)", "Mac OS X (iPad)", ("OS 8_3",), (), "TABLET"),
    System("iOS 8.2 (iPad)", "Mac OS X (iPad)", ("OS 8_2",), (), "TABLET"),
    System("iOS 8.1 (iPad)", "Mac OS X (iPad)", ("OS 8_1",), (), "TABLET"),
    System("iOS 8 (iPad)", "Mac OS X (iPad)", ("OS 8_0",), (), "TABLET"),
    System("iOS 7 (iPad)", "Mac OS X (iPad)", ("OS 7",), (), "TABLET"),
    System("iOS 6 (iPad)", "Mac OS X (iPad)", ("OS 6",), (), "TABLET"),
    System("Mac OS X (iPhone)", "iOS", ("iPhone",), (), "MOBILE"),
    System("Mac OS X (iPod)", "iOS", ("iPod",), (), "MOBILE"),
    System("Mac OS X", None, ("Mac OS X", "CFNetwork"), (), "COMPUTER"),
    System("Mac OS", None, ("Mac",), (), "COMPUTER"),
    System("Maemo", None, ("Maemo",), (), "MOBILE"),
    System("Bada", None, ("Bada",), (), "MOBILE"),
    System("Android (Google TV)", None, ("GoogleTV",), (), "DMR"),
    System("Tizen", None, ("Tizen",), (), "UNKNOWN"),
    System("Tizen 3", "Tizen", ("Tizen 3.",), (), "UNKNOWN"),
    System("Tizen 3 (Mobile)", "Tizen 3", ("mobile",), (), "MOBILE"),
    System("Tizen 3 (SmartTV)", "Tizen 3", ("Smart-TV", " TV "), (), "DMR"),
    System("Tizen 2", "Tizen", ("Tizen 2.",), (), "UNKNOWN"),
    System("Tizen 2 (Mobile)", "Tizen 2", ("mobile",), (), "MOBILE"),
    System("Tizen 2 (SmartTV)", "Tizen 2", ("Smart-TV", " TV "), (), "DMR"),
    System("Tizen (mobile)", "Tizen", ("mobile",), (), "MOBILE"),
    System("Linux (Kindle)", None, ("Kindle",), (), "TABLET"),
    System("Linux (Kindle 3)", "Linux (Kindle)", ("Kindle/3",), (), "TABLET"),
    System("Linux (Kindle 2)", "Linux (Kindle)", ("Kindle/2",), (), "TABLET"),
    System("Linux", None, ("Linux", "CamelHttpStream"), (), "COMPUTER"),
    System("Ubuntu", "Linux", ("ubuntu",), (), "COMPUTER"),
    System("Ubuntu Touch (mobile)", "Ubuntu", ("mobile",), (), "MOBILE"),
    System("Linux (SmartTV)", "Linux", ("SmartTv",), (), "DMR"),
    System("Symbian OS", None, ("Symbian", "Series60"), (), "MOBILE"),
    System("Symbian OS 9.x", "Symbian OS", ("SymbianOS/9", "Series60/3"), (), "MOBILE"),
    System("Symbian OS 8.x", "Symbian OS", ("SymbianOS/8", "Series60/2.6", "Series60/2.8"), (), "MOBILE"),
    System("Symbian OS 7.x", "Symbian OS", ("SymbianOS/7",), (), "MOBILE"),
    System("Symbian OS 6.x", "Symbian OS", ("SymbianOS/6",), (), "MOBILE"),
    System("Series 40", None, ("Nokia6300",), (), "MOBILE"),
    System("Sony Ericsson", None, ("SonyEricsson",), (), "MOBILE"),
    System("SunOS", None, ("SunOS",), (), "COMPUTER"),
    System("Sony Playstation", None, ("Playstation",), (), "GAME_CONSOLE"),
    System("Nintendo Wii", None, ("Wii",), (), "GAME_CONSOLE"),
    System("BlackBerryOS", None, ("BlackBerry",), (), "MOBILE"),
    System("BlackBerry 7", "BlackBerryOS", ("Version/7",), (), "MOBILE"),
    System("BlackBerry 6", "BlackBerryOS", ("Version/6",), (), "MOBILE"),
    System("BlackBerry Tablet OS", None, ("RIM Tablet OS",), (), "TABLET"),
    System("Roku OS", None, ("Roku",), (), "DMR"),
    System("Proxy", None, ("ggpht.com",), (), "UNKNOWN"),
    System("Unknown mobile", None, ("Mobile",), (), "MOBILE"),
    System("Unknown tablet", None, ("Tablet",), (), "TABLET"),
]

# Product and what its addresses hold.
WEBMAIL = [
    ("Windows Live Hotmail", ("mail.live.com", "hotmail.msn")),
    ("Gmail", ("mail.google.com",)),
    ("Yahoo Mail", ("mail.yahoo.com",)),
    ("Compuserve", ("csmail.compuserve.com",)),
    ("AOL webmail", ("webmail.aol.com",)),
    ("MobileMe", ("www.me.com",)),
    ("Mail.com", (".mail.com",)),
    ("horde", ("horde",)),
    ("Other webmail client", ("webmail", "webemail")),
]

# Engine version and Safari version, for agents that do not name the latter.
WEBKIT_SAFARI = {
    "48": "0.8",
    "73": "0.9",
    "85": "1.0",
    "85.8.5": "1.0.3",
    "100": "1.1",
    "125": "1.2",
    "312": "1.3",
    "312.3": "1.3.1",
    "312.5": "1.3.2",
    "312.6": "1.3.2",
    "412": "2.0",
    "416.11": "2.0.2",
    "419.3": "2.0.4",
    "522.11": "3.0",
    "522.12": "3.0.2",
    "522.12.1": "3.0.3",
    "523.10": "3.0.4",
    "525.20": "3.1.1",
    "525.21": "3.1.2",
    "525.26": "3.2",
    "525.27": "3.2.1",
    "525.28": "3.2.3",
    "530.18": "4.0.1",
    "530.19": "4.0.2",
    "531.9": "4.0.3",
    "531.21.10": "4.0.4",
    "531.22.7": "4.0.5",
    "533.20.27": "5.0.4",
    "533.21.1": "5.0.5",
    "533.22.3": "5.0.6",
    "534.48.3": "5.1",
    "534.51.22": "5.1.1",
    "534.52.7": "5.1.2",
    "534.53.10": "5.1.3",
    "534.54.16": "5.1.4",
    "534.55.3": "5.1.5",
    "534.56.5": "5.1.6",
    "534.57.2": "5.1.7",
    "534.58.2": "5.1.8",
    "534.59.8": "5.1.9",
    "534.59.10": "5.1.10",
    "536.25": "6.0",
    "536.26": "6.0.1",
    "536.26.17": "6.0.2",
    "536.28.10": "6.0.3",
    "536.29.13": "6.0.4",
    "536.30.1": "6.0.5",
    "537.43.58": "6.1",
    "537.71": "7.0",
    "537.75.14": "7.0.3",
    "537.76.4": "7.0.4",
    "537.77.4": "7.0.5",
    "538.35.8": "8.0",
    "600.6.3": "8.0.6",
    "600.7.12": "8.0.7",
    "601.2.7": "9.0.1",
    "601.3.9": "9.0.2",
    "601.4.4": "9.0.3",
    "601.5.17": "9.1",
    "601.6.17": "9.1.1",
    "601.7.1": "9.1.2",
    "601.7.8": "9.1.3",
    "602.1.50": "10",
    "602.2.14": "10.0.1",
    "602.3.12": "10.0.2",
    "602.4.8": "10.0.3",
    "603.1.30": "10.1",
    "603.2.4": "10.1.1",
    "603.3.8": "10.1.2",
    "522.11.3": "3.0",
    "522.13.1": "3.0.2",
    "522.12.2": "3.0.1",
    "522.15.5": "3.0.3",
    "523.12.9": "3.0.4",
    "523.13": "3.0.4",
    "523.15": "3.0.4",
    "525.13": "3.1",
    "525.17": "3.1.1",
    "525.26.13": "3.2",
    "525.27.1": "3.2.1",
    "525.28.1": "3.2.2",
    "525.29.1": "3.2.3",
    "526.12.2": "4.0",
    "528.1.1": "4.0",
    "526.11.2": "4.0",
    "528.16": "4.0",
    "528.17": "4.0",
    "530.19.1": "4.0.2",
    "531.9.1": "4.0.3",
    "534.50": "5.1",
}
