"""Signature rules of the license scan, in order of priority.

Each line: a word that every match holds, a confidence, a label, a pattern. Patterns are
matched against lower-cased words joined by single spaces, at word borders.
"""

#: The phrases that are always reported.
BASE = """
gnu 0.8 gpl gnu general public license
apache 0.8 apache apache license
cc 0.7 cc-by cc by
mit 0.8 mit mit license
"""

RULES = """
redistribution 1.0 bsd-4-clause redistributions? (?:\\w+ ){1,80}all advertising materials mentioning features or use of this software must display
redistribution 1.0 bsd-3-clause redistribution and use in source and binary forms(?: \\w+){20,120} neither the names? of
redistribution 0.9 bsd-2-clause redistribution and use in source and binary forms(?: with or without modification)? are permitted
neither 0.8 bsd-3-clause neither the names? of (?:\\w+ ){1,14}nor the names of its contributors may be used to endorse
advertising 0.8 bsd-4-clause all advertising materials mentioning features or use of this software
permission 1.0 mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
permission 1.0 isc permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
permission 0.9 hpnd permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?
permission 1.0 bsl-1.0 permission is hereby granted free of charge to any person or organization obtaining a copy of the software
permission 0.9 ofl-1.1 permission is hereby granted free of charge to any person obtaining a copy of the font software
permission 0.7 unknown-permissive permission is (?:hereby )?granted(?: free of charge)? to
everyone 1.0 wtfpl everyone is permitted to copy and distribute verbatim or modified copies of this license document
encumbered 1.0 unlicense this is free and unencumbered software released into the public domain
unencumbered 1.0 unlicense free and unencumbered software released into the public domain
warranty 0.9 zlib this software is provided as is without any express or implied warranty in no event will the authors be held liable
altered 0.9 zlib altered source versions must be plainly marked as such
misrepresented 0.9 zlib the origin of this software must not be misrepresented
eclipse 0.6 epl contributors? (?:\\w+ ){0,6}eclipse foundation
affero 1.0 agpl-3.0-or-later gnu affero general public license(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or(?: at your option)? any later version
affero 1.0 agpl-3.0 gnu affero general public license(?: \\w+){0,8} (?:version |v)3(?: 0)?
affero 0.9 agpl-1.0 affero general public license (?:version |v)1(?: 0)?
affero 0.9 agpl gnu affero general public licen[sc]e
affero 0.7 agpl affero (?:gpl|general public)
agplv3 0.9 agpl-3.0 (?:gnu )?agplv3
agpl 0.95 agpl-3.0-only agpl 3(?: 0)? only
agpl 0.95 agpl-3.0-or-later agpl 3(?: 0)? or later
agpl 0.9 agpl-3.0 agpl (?:version |v)?3(?: 0)?
agpl 0.7 agpl agpl
lesser 1.0 lgpl-3.0-or-later gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or(?: at your option)? any later version
lesser 1.0 lgpl-2.1-or-later gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 2 1(?: of the license)? or(?: at your option)? any later version
lesser 0.95 lgpl-3.0 gnu lesser general public license(?: \\w+){0,8} (?:version |v)3(?: 0)?
lesser 0.95 lgpl-2.1 gnu lesser general public license(?: \\w+){0,8} (?:version |v)2 1
library 0.95 lgpl-2.0 gnu library general public license(?: \\w+){0,8} (?:version |v)2(?: 0)?
library 0.9 lgpl-2.0 gnu library general public licen[sc]e
lesser 0.9 lgpl gnu lesser (?:general )?public licen[sc]e
lesser 0.7 lgpl lesser gpl
lgplv3 0.9 lgpl-3.0 (?:gnu )?lgplv3
lgplv2 0.9 lgpl-2.1 (?:gnu )?lgplv2(?: 1)?
lgpl 0.95 lgpl-2.1-only lgpl 2 1 only
lgpl 0.95 lgpl-2.1-or-later lgpl 2 1 or later
lgpl 0.95 lgpl-3.0-only lgpl 3(?: 0)? only
lgpl 0.95 lgpl-3.0-or-later lgpl 3(?: 0)? or later
lgpl 0.9 lgpl-2.1 lgpl (?:version |v)?2 1
lgpl 0.9 lgpl-3.0 lgpl (?:version |v)?3(?: 0)?
lgpl 0.7 lgpl lgpl
documentation 0.95 gfdl-1.3 gnu free documentation license(?: \\w+){0,3} (?:version |v)1 3
documentation 0.95 gfdl-1.2 gnu free documentation license(?: \\w+){0,3} (?:version |v)1 2
documentation 0.9 gfdl gnu free documentation licen[sc]e
gfdl 0.7 gfdl gfdl
general 1.0 gpl-3.0-or-later gnu general public license(?: as published by the free software foundation)?(?: either)? version 3(?: of the license)? or(?: at your option)? any later version
general 1.0 gpl-2.0-or-later gnu general public license(?: as published by the free software foundation)?(?: either)? version 2(?: of the license)? or(?: at your option)? any later version
classpath 1.0 gpl-2.0-with-classpath-exception gnu general public license(?: \\w+){0,8} classpath exception
classpath 0.9 gpl-2.0-with-classpath-exception gpl(?: \\w+){0,6} classpath exception
general 0.95 gpl-3.0 gnu general public license(?: \\w+){0,8} (?:version |v)3(?: 0)?
general 0.95 gpl-2.0 gnu general public license(?: \\w+){0,8} (?:version |v)2(?: 0)?
general 0.95 gpl-1.0 gnu general public license(?: \\w+){0,8} (?:version |v)1(?: 0)?
general 0.8 gpl (?:the )?general public licen[sc]e
gplv3 0.9 gpl-3.0 (?:gnu )?gplv3
gplv2 0.9 gpl-2.0 (?:gnu )?gplv2
gpl 0.95 gpl-2.0-only gpl 2(?: 0)? only
gpl 0.95 gpl-2.0-or-later gpl 2(?: 0)? or later
gpl 0.95 gpl-3.0-only gpl 3(?: 0)? only
gpl 0.95 gpl-3.0-or-later gpl 3(?: 0)? or later
gpl 0.9 gpl-2.0 (?:gnu )?gpl (?:version |v)?2(?: 0)?
gpl 0.9 gpl-3.0 (?:gnu )?gpl (?:version |v)?3(?: 0)?
gpl 0.9 gpl-2.0 (?:gnu )?gpl v2
gpl 0.9 gpl-3.0 (?:gnu )?gpl v3
gpl 0.7 gpl (?:gnu )?gpl
copyleft 0.5 gpl gnu copyleft
apache 1.0 apache-2.0 licensed under the apache license version 2 0
apache 0.95 apache-2.0 apache(?: software)? licen[sc]e(?: \\w+){0,2} (?:version |v)?2(?: 0)?
apache 0.95 apache-2.0 www apache org licenses license 2 0
apache 0.95 apache-1.1 apache(?: software)? licen[sc]e (?:version |v)?1 1
apache 0.9 apache-1.0 apache(?: software)? licen[sc]e (?:version |v)?1 0
apache 0.9 apache-2.0 apache 2(?: 0)?
apache 0.8 apache apache software licen[sc]e
apache 0.7 apache apache licensed
apache 0.7 apache apache licence
asl 0.6 apache-2.0 asl 2(?: 0)?
mit 0.95 mit-0 mit 0(?: license)?
mit 0.9 mit-0 mit no attribution
mit 0.9 mit licensed under (?:the )?mit
mit 0.9 mit (?:the )?mit(?: style| x11)? licen[sc]e
mit 0.9 mit released under (?:the )?mit
mit 0.7 mit mit licensed
mit 0.8 mit (?:spdx license identifier|opensource org licenses) mit
expat 0.8 mit expat licen[sc]e
x11 0.8 x11 x11 licen[sc]e
x11 0.6 x11 mit x11
bsd 0.95 bsd-4-clause bsd 4 clause
bsd 0.95 bsd-3-clause bsd 3 clause(?: clear)?
bsd 0.95 bsd-2-clause bsd 2 clause(?: patent)?
bsd 0.95 0bsd (?:zero clause bsd|bsd zero clause|bsd 0 clause)
0bsd 0.95 0bsd 0bsd
bsd 0.9 bsd-4-clause (?:4|four) clause bsd
bsd 0.9 bsd-3-clause (?:3|three) clause bsd
bsd 0.9 bsd-2-clause (?:2|two) clause bsd
bsd 0.9 bsd-3-clause (?:new|revised|modified) bsd
bsd 0.9 bsd-2-clause simplified bsd
freebsd 0.8 bsd-2-clause freebsd licen[sc]e
bsd 0.8 bsd bsd(?: style)? licen[sc]e
bsd 0.7 bsd (?:licensed|released|distributed) under (?:the |a )?bsd
berkeley 0.6 bsd berkeley software distribution licen[sc]e
isc 0.9 isc (?:the )?isc licen[sc]e
isc 0.8 isc licensed under (?:the )?isc
mozilla 1.0 mpl-2.0 subject to the terms of the mozilla public license v(?:ersion)? ?2 0
mozilla 0.95 mpl-2.0 mozilla public license(?: \\w+){0,3} (?:version |v)?2(?: 0)?
mozilla 0.95 mpl-1.1 mozilla public license(?: \\w+){0,3} (?:version |v)?1 1
mozilla 0.9 mpl-1.0 mozilla public license (?:version |v)?1 0
mozilla 0.8 mpl mozilla public licen[sc]e
mpl 0.95 mpl-2.0 mpl (?:version |v)?2(?: 0)?
mpl 0.95 mpl-1.1 mpl (?:version |v)?1 1
mpl 0.6 mpl mpl licen[sc]e
eclipse 0.95 epl-2.0 eclipse public license(?: \\w+){0,3} (?:version |v)?2(?: 0)?
eclipse 0.95 epl-1.0 eclipse public license(?: \\w+){0,3} (?:version |v)?1(?: 0)?
eclipse 0.8 epl eclipse public licen[sc]e
eclipse 0.9 edl-1.0 eclipse distribution licen[sc]e
epl 0.95 epl-2.0 epl (?:version |v)?2(?: 0)?
epl 0.95 epl-1.0 epl (?:version |v)?1(?: 0)?
cddl 0.95 cddl-1.1 cddl (?:version |v)?1 1
cddl 0.95 cddl-1.0 cddl (?:version |v)?1(?: 0)?
cddl 0.8 cddl cddl
common 0.9 cddl-1.0 common development and distribution license(?: \\w+){0,2} (?:version |v)?1 0
common 0.8 cddl common development and distribution licen[sc]e
common 0.9 cpl-1.0 common public license(?: \\w+){0,2} (?:version |v)?1 0
common 0.8 cpl-1.0 common public licen[sc]e
cpal 0.8 cpal-1.0 cpal(?: 1 0)?
attribution 0.9 cpal-1.0 common public attribution licen[sc]e
european 0.95 eupl-1.2 european union public licen[sc]e(?: \\w+){0,2} (?:version |v)?1 2
european 0.95 eupl-1.1 european union public licen[sc]e(?: \\w+){0,2} (?:version |v)?1 1
european 0.8 eupl european union public licen[sc]e
eupl 0.9 eupl-1.2 eupl (?:version |v)?1 2
eupl 0.9 eupl-1.1 eupl (?:version |v)?1 1
eupl 0.7 eupl eupl
cecill 0.9 cecill-2.1 cecill (?:version |v)?2 1
cecill 0.9 cecill-b cecill b
cecill 0.9 cecill-c cecill c
cecill 0.7 cecill cecill
artistic 0.95 artistic-2.0 artistic licen[sc]e(?: \\w+){0,2} (?:version |v)?2(?: 0)?
artistic 0.95 artistic-1.0 artistic licen[sc]e(?: \\w+){0,2} (?:version |v)?1(?: 0)?
artistic 0.8 artistic (?:the )?artistic licen[sc]e
perl 0.8 artistic-1.0-perl same terms as perl itself
python 0.95 python-2.0 python software foundation license(?: \\w+){0,2} (?:version |v)?2
python 0.8 python-2.0 (?:python software foundation|psf) licen[sc]e
psf 0.7 python-2.0 psf (?:licen[sc]e|2 0)
ruby 0.7 ruby ruby licen[sc]e
php 0.9 php-3.01 php licen[sc]e(?: \\w+){0,2} (?:version |v)?3 01
php 0.7 php php licen[sc]e
zope 0.9 zpl-2.1 zope public licen[sc]e(?: \\w+){0,2} (?:version |v)?2 1
zope 0.8 zpl zope public licen[sc]e
zlib 0.9 zlib zlib(?: libpng)? licen[sc]e
libpng 0.8 libpng libpng licen[sc]e
openssl 0.8 openssl openssl licen[sc]e
ssleay 0.8 openssl (?:original )?ssleay licen[sc]e
boost 0.95 bsl-1.0 boost software licen[sc]e(?: \\w+){0,2} (?:version |v)?1 0
boost 0.8 bsl-1.0 boost software licen[sc]e
bsl 0.8 bsl-1.0 bsl 1 0
business 0.95 busl-1.1 business source license(?: \\w+){0,2} (?:version |v)?1 1
business 0.8 busl-1.1 business source licen[sc]e
busl 0.9 busl-1.1 busl 1 1
elastic 0.95 elastic-2.0 elastic licen[sc]e(?: \\w+){0,2} (?:version |v)?2(?: 0)?
elastic 0.8 elastic elastic licen[sc]e
sspl 0.9 sspl-1.0 sspl(?: 1 0)?
server 0.9 sspl-1.0 server side public licen[sc]e
commons 0.9 commons-clause commons clause(?: licen[sc]e)?
polyform 0.9 polyform-noncommercial polyform non ?commercial
polyform 0.8 polyform polyform \\w+ licen[sc]e
prosperity 0.8 prosperity prosperity public licen[sc]e
parity 0.8 parity parity public licen[sc]e
microsoft 0.9 ms-pl microsoft public licen[sc]e
microsoft 0.9 ms-rl microsoft reciprocal licen[sc]e
pl 0.8 ms-pl ms pl
rl 0.8 ms-rl ms rl
wtfpl 0.9 wtfpl wtfpl
fuck 0.9 wtfpl do what the fuck you want to public licen[sc]e
unlicense 0.8 unlicense (?:the )?unlicense
beerware 0.8 beerware beerware licen[sc]e
beer 0.7 beerware beer ware licen[sc]e
postgresql 0.8 postgresql postgresql licen[sc]e
ncsa 0.8 ncsa (?:university of illinois )?ncsa(?: open source)? licen[sc]e
illinois 0.8 ncsa university of illinois(?: ncsa)? open source licen[sc]e
w3c 0.8 w3c w3c(?: software)?(?: notice and)? licen[sc]e
curl 0.7 curl curl licen[sc]e
vim 0.7 vim vim licen[sc]e
intel 0.6 intel intel open source licen[sc]e
ibm 0.7 ipl-1.0 ibm public licen[sc]e
apple 0.8 apsl-2.0 apple public source licen[sc]e
sun 0.7 spl-1.0 sun public licen[sc]e
nokia 0.7 nokia nokia open source licen[sc]e
netscape 0.8 npl-1.1 netscape public licen[sc]e
academic 0.8 afl-3.0 academic free licen[sc]e
open 0.8 osl-3.0 open software licen[sc]e(?: \\w+){0,2} (?:version |v)?3 0
open 0.8 odbl-1.0 open (?:data commons open )?database licen[sc]e
odbl 0.8 odbl-1.0 odbl
odc 0.8 odc-by-1.0 odc by
pddl 0.8 pddl-1.0 (?:odc )?pddl
sil 0.9 ofl-1.1 sil open font licen[sc]e(?: \\w+){0,2} (?:version |v)?1 1
sil 0.8 ofl sil open font licen[sc]e
font 0.8 ofl open font licen[sc]e
ofl 0.8 ofl-1.1 ofl 1 1
mulan 0.9 mulanpsl-2.0 mulan permissive software licen[sc]e
mulanpsl 0.9 mulanpsl-2.0 mulanpsl 2 0
upl 0.7 upl-1.0 upl 1 0
universal 0.8 upl-1.0 universal permissive licen[sc]e
blueoak 0.8 blueoak-1.0.0 blueoak 1 0 0
blue 0.8 blueoak-1.0.0 blue oak model licen[sc]e
llama 0.9 llama llama(?: \\d)*(?: community)? licen[sc]e(?: agreement)?
openrail 0.9 openrail (?:creativeml |bigscience )?open ?rail(?: m)?
rail 0.7 openrail (?:bigscience )?rail licen[sc]e
cc 0.95 cc-by-nc-nd cc by nc nd(?: \\d 0)?
cc 0.95 cc-by-nc-sa cc by nc sa(?: \\d 0)?
cc 0.95 cc-by-nc cc by nc(?: \\d 0)?
cc 0.95 cc-by-nd cc by nd(?: \\d 0)?
cc 0.95 cc-by-sa cc by sa(?: \\d 0)?
cc 0.95 cc-by-4.0 cc by 4 0
cc 0.95 cc-by-3.0 cc by 3 0
cc 0.95 cc-by-2.0 cc by 2 0
cc0 0.95 cc0-1.0 cc0(?: 1 0)?
cc 0.8 cc0-1.0 cc zero
creativecommons 0.95 cc-by-nc-nd creativecommons org licenses by nc nd
creativecommons 0.95 cc-by-nc-sa creativecommons org licenses by nc sa
creativecommons 0.95 cc-by-nc creativecommons org licenses by nc
creativecommons 0.95 cc-by-nd creativecommons org licenses by nd
creativecommons 0.95 cc-by-sa creativecommons org licenses by sa
creativecommons 0.95 cc-by creativecommons org licenses by
creativecommons 0.95 cc0-1.0 creativecommons org publicdomain zero
creative 0.95 cc-by-nc-nd creative commons attribution non ?commercial no ?deriv(?:ative)?s?
creative 0.95 cc-by-nc-sa creative commons attribution non ?commercial share ?alike
creative 0.95 cc-by-nc creative commons attribution non ?commercial
creative 0.95 cc-by-nd creative commons attribution no ?deriv(?:ative)?s?
creative 0.95 cc-by-sa creative commons attribution share ?alike
creative 0.9 cc-by creative commons attribution(?: \\d 0)?(?: international| unported)?
creative 0.9 cc0-1.0 creative commons (?:cc0|zero)
creative 0.6 cc creative commons(?: licen[sc]e)?
sampling 0.7 cc-sampling creative commons sampling
public 0.8 public-domain (?:released|placed|dedicated) (?:in)?to the public domain
public 0.7 public-domain (?:is|are) in the public domain
domain 0.5 public-domain public domain
reserved 0.8 proprietary all rights reserved
proprietary 0.9 proprietary proprietary and confidential
confidential 0.8 proprietary confidential (?:and|or) proprietary
unauthorized 0.8 proprietary unauthorized (?:copying|use|reproduction)(?: or \\w+)? (?:of this file |of this software )?(?:\\w+ ){0,6}(?:strictly )?prohibited
eula 0.6 proprietary end user licen[sc]e agreement(?: eula)?
user 0.6 proprietary end user licen[sc]e agreement
commercial 0.7 non-commercial (?:for )?non commercial use only
noncommercial 0.7 non-commercial noncommercial use only
academic 0.6 non-commercial academic use only
research 0.6 non-commercial research purposes only
"""
